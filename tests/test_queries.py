"""Every query against its SQL counterpart in DuckDB, on the smallest tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from shopmart.plans import registry
from shopmart.sources import standin

TABLES = Path("/root/testdata/sf0.001")
ORACLE = entry.oracle_sql()
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value)


def test_every_query_but_the_file_audit_has_sql():
    assert set(registry.names()) - set(ORACLE) == {"load_audit"}
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(TABLES))
    result = duck.execute(ORACLE[name])
    types = {c[0]: str(c[1]) for c in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    names = [c[0] for c in result.description]
    expected = sorted(tuple(plain(v) for v in row) for row in result.fetchall())
    got = sorted(tuple(plain(row[c]) for c in names) for row in df.collect())
    assert got == expected


def test_queries_do_without_the_text_operators(monkeypatch):
    """Whether the subpackage, one of its modules or the pipeline is gone, the others stay."""
    for gone in ("shopmart.llm", "shopmart.llm.registry", "shopmart.llm.tokens", "corpus_pipeline"):
        with monkeypatch.context() as patch:
            for name in [n for n in sys.modules if n.startswith(("shopmart.llm", "corpus_pipeline"))]:
                patch.delitem(sys.modules, name)
            if "shopmart.llm" in vars(sys.modules["shopmart"]):
                patch.delattr(sys.modules["shopmart"], "llm")
            patch.setitem(sys.modules, gone, None)
            assert set(entry.queries()) == set(registry.names())
            assert set(entry.oracle_sql()) <= set(registry.names())


def test_entry_returns_the_kpis(spark):
    assert entry.entry(spark).count() == 1


def test_file_audit(spark):
    audit = entry.queries()["load_audit"](spark, str(TABLES)).collect()
    assert {r.table_name for r in audit} >= {"orders", "lineitem"}
    assert all(len(r.sha256) == 64 and r.row_count > 0 for r in audit)


def test_file_audit_of_tables_stored_as_folders(spark, tmp_path):
    rows = {}
    for path in TABLES.glob("*.parquet"):
        frame = spark.read.parquet(str(path))
        (frame.repartition(3) if path.stem in ("orders", "lineitem") else frame).write.parquet(f"{tmp_path}/{path.name}")
        rows[path.stem] = frame.count()
    audit = entry.queries()["load_audit"](spark, str(tmp_path)).collect()
    assert {r.table_name for r in audit} == set(standin.TABLES)
    for name in standin.TABLES:
        assert sum(r.row_count for r in audit if r.table_name == name) == rows[name]
    assert sum(r.table_name == "orders" for r in audit) == 3


def test_file_audit_of_partition_folders(spark, tmp_path):
    """Parts below partition folders, of the same name in two of them, and one without rows."""
    for path in TABLES.glob("*.parquet"):
        frame = spark.read.parquet(str(path))
        frame.coalesce(1).write.parquet(f"{tmp_path}/{path.name}")
    table = tmp_path / "orders.parquet"
    orders = spark.read.parquet(str(table))
    n = orders.count()
    more = {"year=1997": orders.limit(5), "year=1999": orders.limit(7), "year=1998": orders.limit(0)}
    [old] = table.glob("part-*")
    for folder, rows in more.items():
        rows.coalesce(1).write.parquet(str(tmp_path / "made" / folder))
        [made] = (tmp_path / "made" / folder).glob("part-*")
        (table / folder).mkdir()
        (table / folder / "part-0.parquet").write_bytes(made.read_bytes())
    (table / "year=1996").mkdir()
    (table / "year=1996" / "part-0.parquet").write_bytes(old.read_bytes())
    old.unlink()
    for crc in table.glob(".*.crc"):
        crc.unlink()
    audit = entry.queries()["load_audit"](spark, str(tmp_path)).collect()
    assert sorted(r.row_count for r in audit if r.table_name == "orders") == sorted([0, 5, 7, n])
    assert {r.table_name for r in audit} == set(standin.TABLES)
