"""Session helpers: table access, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir`` (a file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage of ``df`` by a reliable checkpoint.

    The folder is the one the session names in ``spark.checkpoint.dir``.  Only
    a local session may fall back to a temporary folder, because a cluster's
    executors would not share it.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir")
        if configured:
            sc.setCheckpointDir(configured)
        elif sc.master.startswith("local[") or sc.master == "local":
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="packetloom-"))
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return df.checkpoint(eager)


def small_rows(df: DataFrame, limit: int) -> list | None:
    """All rows of ``df`` when there are at most ``limit``; None when there are more.

    This is the size check in front of every driver-side structure and
    broadcast: the read stops after ``limit + 1`` rows, so a table that turned
    out large costs nothing.
    """
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def maybe_broadcast(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Broadcast ``df`` when it has at most ``limit`` rows, else leave the join to Catalyst."""
    n = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return F.broadcast(df) if n <= limit else df
