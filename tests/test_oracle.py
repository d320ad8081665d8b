"""Every listings plan with an SQL twin gives the twin's rows."""

import math
import os

import duckdb
import pytest

from hearth.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


def shown(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int | float) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_plan_matches_its_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(columns)
    a = sorted(tuple(shown(r[c]) for c in order) for r in got.collect())
    b = sorted(tuple(shown(r[columns.index(c)]) for c in order) for r in want.fetchall())
    assert a == b


def test_entry_and_registries(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_does_not_import_the_optional_subpackage():
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "hearth"
    for p in root.rglob("*.py"):
        if "llm" not in p.parts:
            assert "hearth.llm" not in p.read_text(), p
