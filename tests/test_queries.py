import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
WITH_SQL = sorted(set(entry.oracle_sql()))


def test_register():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert len(queries) > 100 and set(oracles) <= set(queries)
    assert "p3_found" in queries


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", WITH_SQL)
def test_against_sql(spark, name):
    import duckdb

    found = entry.queries()[name](spark, FOLDER)
    db = duckdb.connect()
    for file in os.listdir(FOLDER):
        db.sql(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{FOLDER}/{file}'")
    wanted = db.sql(entry.oracle_sql()[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    order = sorted(found.columns)
    plain = lambda row: tuple(repr(round(float(v), 6)) if isinstance(v, (int, float, bool)) else str(v) for v in row)
    a = sorted(plain(r) for r in found.select(*order).collect())
    b = sorted(plain(r) for r in wanted.select(*order).fetchall())
    assert a == b


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_band_join_of_all_parts_matches_sql(spark):
    test_against_sql(spark, "band_join_all")
    parts = spark.read.parquet(f"{FOLDER}/part.parquet").filter("p_size <> 50").select("p_partkey")
    found = entry.queries()["band_join_all"](spark, FOLDER)
    assert found.join(parts, found["a"] == parts["p_partkey"]).count() > 0
