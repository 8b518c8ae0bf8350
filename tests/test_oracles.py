"""Every registered query beside its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark import catalog
from tidemark.compare import duck_rows, register_tables, same_rows, spark_rows

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    register_tables(con, sf)
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, duck, name):
    mine = spark_rows(catalog.QUERIES[name](spark, sf))
    assert mine[1]
    sql = catalog.ORACLES.get(name)
    if sql:
        verdict = same_rows(mine, duck_rows(duck, sql))
        assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry.entry(spark).columns == ["window_end", "item_id", "icount", "row_num"]


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_sketch_is_close(spark, sf):
    assert all(r.within_error for r in catalog.QUERIES["uv_approx"](spark, sf).collect())


STREAMS = [n for n in NAMES if n.startswith("stream_") or n == "tumble_count_wm"]


@pytest.mark.parametrize("name", STREAMS)
def test_stream_reads_folders(spark, sf, tmp_path, name):
    for table in ("events", "orders", "lineitem"):
        spark.read.parquet(f"{sf}/{table}.parquet").repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    whole, parts = catalog.QUERIES[name](spark, sf), catalog.QUERIES[name](spark, str(tmp_path))
    assert spark_rows(whole)[1] and same_rows(spark_rows(parts), spark_rows(whole)).startswith("ok")
