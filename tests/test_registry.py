"""Every registered query against its DuckDB oracle on the smallest tables."""

import decimal
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from foldline.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return int(v)
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, rows) == _canon(ocols, orows)
    spark_types = dict(df.dtypes)
    for column, duck_type in zip(ocols, (str(d[1]) for d in rel.description)):
        assert TYPES.get(spark_types[column], spark_types[column].upper()) == duck_type, column


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "occurrences" and df.count() > 0


def test_single_file_parts_follow_the_size_of_the_table(spark, tmp_dir, monkeypatch):
    """No task reads a fixed share of the table: more rows make more parts, not larger ones."""
    from foldline import registry

    dealt, publish = [], registry.publish_file

    def noted(rows, *args, **options):
        dealt.append([r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()])
        return publish(rows, *args, **options)

    monkeypatch.setattr(registry, "publish_file", noted)
    monkeypatch.setattr(registry, "PART_BYTES", 4096, raising=False)
    for size in (500, 4000):
        rows = spark.range(size).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
        rows.write.parquet(f"{tmp_dir}/{size}/documents.parquet")
        got = registry.csv_single_file(spark, f"{tmp_dir}/{size}")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    small, large = dealt[:2], dealt[2:]
    for a, b in zip(small, large):
        assert sum(b) == 8 * sum(a) and len(b) > len(a) >= 3
        assert max(b) < 2 * max(a)
