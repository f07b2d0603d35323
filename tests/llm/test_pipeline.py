"""Registered queries against DuckDB, and the pipeline's stages against plain versions."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from foldline.llm.oracles import ORACLE_SQL  # noqa: E402
from foldline.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    frame = QUERIES[name](spark, SF)
    rel = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(frame.columns)

    def norm(v):
        return float(f"{v:.9g}") if isinstance(v, float) else v

    want = Counter(tuple(norm(v) for v in r) for r in rel.fetchall())
    assert Counter(tuple(norm(r[c]) for c in names) for r in frame.collect()) == want and want


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows on the whole documents table, written and read as its successor's input."""
    from foldline.llm.common import materialize, table

    docs = table(spark, SF, "documents").withColumn("component_id", F.lit("clash"))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, out[-1], SF)
        out.append(materialize(found, f"test-{name}"))
    return out


def rows(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def test_stages_hand_on_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert set(stages[0].columns) < set(stages[-1].columns)


def test_quality_stage(stages):
    kept = rows(stages[1])
    everything = dict(rows(stages[0]))
    assert 0 < len(kept) < len(everything)
    for _, text in kept:
        c = brute.quality_counts(text)
        assert c[0] >= 50 and 100 * c[4] <= 50 * c[0]


def test_distinct_stage_keeps_one_of_each_group(stages):
    before = sorted(rows(stages[1]))
    roots, _ = brute.components([t for _, t in before])
    assert sorted(rows(stages[2])) == [before[i] for i in sorted(set(roots))]


def test_distinct_stage_judges_each_text_of_an_id(spark):
    """One id with two texts, near copies without an id, and repeated rows that differ elsewhere."""
    body, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    data = [(1, body, "a"), (2, body + " x", "b"), (2, other, "c"), (None, body + " y", "d"), (None, other + " z", "e"),
            (7, "alone", "f"), (7, "alone", "e"), (7, "alone", "g"), (8, None, "h"), (9, None, "i"), (None, "", "j"), (None, "", "k")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").withColumn("key", F.lit("clash"))
    kept = corpus_pipeline.keep_distinct(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((tuple(r)[:3] for r in kept.collect()), key=repr) == sorted(
        [(1, body, "a"), (2, other, "c"), (7, "alone", "e"), (8, None, "h"), (9, None, "i"), (None, "", "j")], key=repr)


def test_decontamination_stage(spark, stages):
    items = [brute.shingle_set(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def clean(text):
        have = brute.shingle_set(text)
        return not any(i and 100 * len(i & have) >= 75 * len(i) for i in items)

    assert sorted(rows(stages[3])) == sorted(r for r in rows(stages[2]) if clean(r[1]))


def test_mixing_stage_repeats_whole_documents(stages):
    before, after = Counter(rows(stages[3])), Counter(rows(stages[4]))
    assert set(after) <= set(before) and max(after.values()) <= 3
    total = sum(len(brute.words(t)) for _, t in before)
    mixed = sum(len(brute.words(t)) * n for (_, t), n in after.items())
    assert total - 20 * max(len(brute.words(t)) for _, t in before) <= mixed <= total


def test_sharding_stage_places_every_row(stages):
    assert Counter(rows(stages[5])) == Counter(rows(stages[4]))
    sizes = Counter(r["shard"] for r in stages[5].select("shard").collect())
    full = [sizes.get(s, 0) for s in range(40)]
    assert max(full) - min(full) <= 1


def test_stages_take_empty_and_null_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in ([], [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0)]):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF).collect()
            assert len(found) == {"ngram_jaccard_join": min(len(data), 2), "decontaminate": len(data), "shard": len(data)}.get(name, 0), name
