"""Readers and sinks for packets, submissions and reports."""

from __future__ import annotations

import csv
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packetloom.functions import text as tx
from packetloom.operators.structural_csv import SUBMISSION_FIELDS

PREDICTION = T.StructType([*(T.StructField(f, T.StringType()) for f in SUBMISSION_FIELDS[:-1]), T.StructField("confidence", T.DoubleType())])
#: Columns of a recogniser's output and wrapper keys of submissions; fixed values.
TSV_COLUMNS = ("level", "page_num", "block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height", "conf", "text")
WRAPPERS = ("predictions", "submission", "results", "cases")


def case_files(spark: SparkSession, folder: str, suffix: str = "pdf") -> DataFrame:
    """name, path, length, sha256, case_id of the folder's own files with the suffix in any case, ordered by name."""
    glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in suffix)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "false").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return files.select(name.alias("name"), "path", "length", F.sha2("content", 256).alias("sha256"), F.when(stem.rlike(tx.CASE_ID), stem).alias("case_id")).orderBy(F.lower("name"), "name")


def read_token_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Word rows (level 5) of tab-separated recogniser output; quotes are ordinary characters.

    Blank words, negative confidences and empty boxes are dropped; a number
    that cannot be read fails the job, as does a header that lacks a column.
    """
    rows = spark.read.option("sep", "\t").option("quote", "").option("header", True).csv(path)
    lacking = [c for c in TSV_COLUMNS if c not in rows.columns]
    if lacking:
        raise ValueError(f"the header lacks {', '.join(lacking)}")
    n = {c: F.col(c).cast("int") for c in TSV_COLUMNS[:10]}
    conf = F.col("conf").cast("double")
    kept = rows.where((n["level"] == 5) & F.col("text").rlike(r"\S") & (conf >= 0) & (n["width"] > 0) & (n["height"] > 0))
    box = F.struct(n["left"].cast("double").alias("left"), n["top"].cast("double").alias("bottom"), (n["left"] + n["width"]).cast("double").alias("right"), (n["top"] + n["height"]).cast("double").alias("top"))
    return kept.select(
        (n["page_num"] - 1).alias("page_index"), tx.strip(F.col("text")).alias("text"), tx.clip(conf / 100, 0.0, 1.0).alias("confidence"), box.alias("box"),
        n["block_num"].alias("block_num"), n["par_num"].alias("paragraph_num"), n["line_num"].alias("line_num"), n["word_num"].alias("word_num"),
    )


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction rows of a CSV, JSON Lines or JSON file (a list, a wrapper object, one row, or rows by id)."""
    suffix = Path(path).suffix.lower()
    if suffix == ".csv":
        raw = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
        return _typed(raw)
    if suffix in (".jsonl", ".ndjson"):
        return spark.read.schema(PREDICTION).json(path)
    if suffix != ".json":
        # unknown suffixes are told by the first mark: a list or one object is JSON, several objects are lines, else CSV
        heads = [r["value"].strip() for r in spark.read.text(path).where(F.col("value").rlike(r"\S")).limit(2).collect()]
        if heads and heads[0][0] not in "[{":
            return _typed(spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path))
        if len(heads) == 2 and all(h.startswith("{") and h.endswith("}") for h in heads):
            return spark.read.schema(PREDICTION).json(path)
    whole = spark.read.text(path, wholetext=True).select(F.trim("value").alias("value"))
    wrapped = T.StructType([T.StructField(w, T.ArrayType(PREDICTION)) for w in WRAPPERS])
    parsed = whole.select(
        "value", F.from_json("value", T.ArrayType(PREDICTION)).alias("rows"), F.from_json("value", wrapped).alias("wrapped"), F.from_json("value", PREDICTION).alias("one"), F.from_json("value", T.MapType(T.StringType(), PREDICTION)).alias("by_id")
    )
    is_list = F.col("value").startswith("[")
    inner = F.coalesce(*(F.col(f"wrapped.{w}") for w in WRAPPERS))
    single = F.col("one.case_id").isNotNull()
    keyed = F.transform(F.map_entries("by_id"), lambda e: e["value"].withField("case_id", F.coalesce(e["value"]["case_id"], e["key"])))
    rows = F.when(is_list, F.col("rows")).when(inner.isNotNull(), inner).when(single, F.array("one")).otherwise(keyed)
    return parsed.select(F.explode(rows).alias("r")).select("r.*")


def _typed(raw: DataFrame) -> DataFrame:
    have = set(raw.columns)
    return raw.select(*(F.col(f) if f in have else F.lit(None).cast("string").alias(f) for f in SUBMISSION_FIELDS[:-1]), (F.col("confidence") if "confidence" in have else F.lit(None)).try_cast("double").alias("confidence"))


def write_predictions(rows: DataFrame, path: str) -> int:
    """JSON Lines sorted by case id with all keys, moved into place when complete; the number of rows.

    Refuses rows with a repeated case id.  The sort is distributed; the file is
    written from a local iterator, partition by partition, so that the driver
    holds one partition at most.
    """
    if rows.groupBy("case_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1):
        raise ValueError("a case id is repeated")
    target = Path(path)
    if not target.parent.is_dir():
        raise FileNotFoundError(target.parent)
    handle, temporary = tempfile.mkstemp(dir=target.parent, prefix=target.name)
    n = 0
    with os.fdopen(handle, "w", encoding="utf-8") as out:
        for r in rows.select(*SUBMISSION_FIELDS).orderBy("case_id").toLocalIterator():
            out.write(json.dumps(r.asDict(), separators=(",", ":")) + "\n")
            n += 1
        out.flush()
        os.fsync(out.fileno())
    os.replace(temporary, target)
    return n


def _checked_target(path: str, refused: str | None) -> Path:
    target = Path(path)
    if refused is not None and Path(refused).resolve() in (target.resolve(), *target.resolve().parents):
        raise ValueError("a report may not be written among the artifacts")
    target.parent.mkdir(parents=True, exist_ok=True)
    return target


def write_report_json(value: dict, path: str, refused: str | None = None) -> None:
    """A report of bounded size as indented JSON with sorted keys, moved into place when complete; ``refused`` is a folder it may not lie in."""
    target = _checked_target(path, refused)
    temporary = target.with_name(f".{target.name}.tmp")
    temporary.write_text(json.dumps(value, indent=2, sort_keys=True) + "\n", encoding="utf-8")
    temporary.replace(target)


def write_report_csv(rows: DataFrame, path: str, refused: str | None = None) -> int:
    """Rows as one CSV file with a header, moved into place when complete; the number of rows.  No rows are an error.

    The rows pass through a local iterator, one partition at a time.
    """
    target = _checked_target(path, refused)
    temporary = target.with_name(f".{target.name}.tmp")
    n = 0
    with temporary.open("w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(rows.columns)
        for r in rows.toLocalIterator():
            writer.writerow(r)
            n += 1
    if not n:
        temporary.unlink()
        raise ValueError("a report without rows")
    temporary.replace(target)
    return n


def write_case_scores(cases: DataFrame, folder: str) -> None:
    """Case scores as JSON with sorted keys, one part a task."""
    cases.select(*sorted(cases.columns)).write.mode("overwrite").json(folder)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """case_id of a manifest: the column of a CSV file, or the stems of a folder's files; each once, blanks left out."""
    if Path(path).suffix.lower() == ".csv":
        ids = spark.read.option("header", True).csv(path).select(tx.strip(F.col("case_id")).alias("case_id"))
    else:
        ids = spark.read.format("binaryFile").load(path).select(F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", "").alias("case_id"))
    return ids.where(F.col("case_id").rlike(r"\S")).distinct()


def read_artifact(path: str, keys: set[str], version: int) -> dict:
    """A versioned JSON artifact with exactly these keys; its digest is that of its canonical form."""
    import hashlib

    held = json.loads(Path(path).read_text())
    if set(held) != keys or held.get("schema_version") != version:
        raise ValueError("the artifact's keys or version are not the expected ones")
    body = {k: v for k, v in held.items() if k != "sha256"}
    digest = hashlib.sha256(json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=True).encode()).hexdigest()
    if "sha256" in held and held["sha256"] != digest:
        raise ValueError("the artifact's checksum does not match")
    return held
