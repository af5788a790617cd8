import decimal
import math
import os

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
CORE = [m for m in entry.MODULES if not m.__name__.startswith("packetloom.llm")]


def plain(row):
    """A row without the differences of notation: no NaN beside None, numbers as rounded floats, lists as tuples."""

    def value(x):
        if isinstance(x, (list, tuple, np.ndarray)):
            return tuple(value(v) for v in x)
        if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and math.isnan(x):
            return None
        if isinstance(x, (bool, np.bool_)):
            return bool(x)
        if isinstance(x, (int, float, np.number, decimal.Decimal)):
            return round(float(x), 6)
        return str(x)

    return tuple(value(x) for x in row)


def test_contract():
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and len(names) > 40


def test_llm_is_not_imported_by_the_rest():
    root = os.path.join(os.path.dirname(entry.__file__), "packetloom")
    for folder, _, names in os.walk(root):
        if os.sep + "llm" in folder:
            continue
        for name in names:
            if name.endswith(".py"):
                assert "packetloom.llm" not in open(os.path.join(folder, name)).read()


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", [n for m in CORE for n in m.QUERIES])
def test_core_queries_equal_their_sql(spark, name):
    import duckdb

    df = entry.queries()[name](spark, SF)
    got = df.toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"create view {file[:-8]} as select * from '{SF}/{file}'")
    want = con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    columns = sorted(got.columns)
    assert sorted(map(repr, map(plain, got[columns].itertuples(index=False)))) == sorted(map(repr, map(plain, want[columns].itertuples(index=False))))
