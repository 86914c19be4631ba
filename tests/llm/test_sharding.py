import duckdb
from conftest import SF
from helpers import docs_of

from tripledger.llm import sharding


def test_same_as_sql_for_many_limits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    for limit in (1 << 30, 100_000, 5_000, 1):
        want = sorted(con.sql(sharding.oracle(limit)).fetchall())
        got = sorted(tuple(r) for r in sharding.extendible_shards(docs, limit).collect())
        assert got == want, limit


def test_shards_fit_and_no_split_is_needless(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    limit = 20_000
    rows = sharding.extendible_shards(docs, limit).collect()
    size = {}
    for r in rows:
        size.setdefault(r.shard, []).append(r.n_bytes)
    assert all(sum(v) <= limit or len(v) == 1 for v in size.values())
    for path in size:  # the parent of a shard holds more than the limit
        if path:
            inside = [b for p, v in size.items() if p.startswith(path[:-1]) for b in v]
            assert sum(inside) > limit and len(inside) > 1
    assert all(not a.startswith(b) for a in size for b in size if a != b)


def test_equal_rows_are_split_too(spark):
    rows = [(7, "x" * 100)] * 300 + [(8, "y" * 5000), (None, None), (9, ""), (9, "")]
    got = sharding.extendible_shards(docs_of(spark, rows, 4), 1000).collect()
    assert len(got) == 304
    size = {}
    for r in got:
        size.setdefault(r.shard, []).append(r.n_bytes)
        assert r.depth == len(r.shard)
    assert all(sum(v) <= 1000 or len(v) == 1 for v in size.values())
    assert all(sum(size[r.shard]) == r.shard_bytes and len(size[r.shard]) == r.shard_docs for r in got)


def test_empty_table_and_clashing_columns(spark):
    docs = docs_of(spark, [(1, "a")]).selectExpr("*", "'x' AS bits", "2 AS n_bytes", "'y' AS shard")
    assert [tuple(r) for r in sharding.extendible_shards(docs, 10).collect()] == [(1, 1, "", 0, 1, 1)]
    assert sharding.extendible_shards(docs.limit(0), 10).collect() == []


def test_no_python_in_the_plan(spark):
    plan = sharding.extendible_shards(docs_of(spark, [(1, "a"), (2, "b")]), 1)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
