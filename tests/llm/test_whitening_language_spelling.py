"""Whitening, language identification and spelling variants against plain versions."""

import math
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from foldline.llm import language_id, spelling, whitening  # noqa: E402
from foldline.llm.language_id import identify_language  # noqa: E402
from foldline.llm.queries import op11_whitening, op12_language_id, op13_spelling_variants  # noqa: E402
from foldline.llm.spelling import near_words, spelling_variants  # noqa: E402
from foldline.llm.whitening import fit_whitening, jacobi_davidson, whitening_report  # noqa: E402

SF = "/root/testdata/sf0.001"

# --------------------------------------------------------------------- whitening


def plain_whitening(vectors, components=16):
    """x, n, S, values and components of usable vectors (lists of floats), by a dense solver."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1][:components], found[:, ::-1][:, :components], values.sum()


def check_whitening(rows, ids, vectors, components=16):
    x, n, sums, values, found, trace = plain_whitening(vectors, components)
    m = int((values > whitening.EPS * x.shape[1] * trace).sum())
    expected = ((n * x - sums) / n) @ found[:, :m] / np.sqrt(values[:m])
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["component"]):
        assert r["n"] == n and r["identity_error"] < 1e-10
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / trace, rel=1e-9)
        got[r["vec_id"]].append(r)
    deviations = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
    signs = None
    for i, one in enumerate(ids):
        assert [r["component"] for r in got[one]] == list(range(1, m + 1))
        assert {r["deviation"] for r in got[one]} == {deviations[i]}
        z = np.array([r["whitened"] for r in got[one]])
        if signs is None:
            signs = np.sign(z * expected[i])
        assert z == pytest.approx(signs * expected[i], abs=1e-8)
    assert len(got) == len(ids)


@pytest.mark.parametrize("dimension,wanted,spectrum", [
    (2, 2, [5, 1]), (40, 16, None), (64, 16, "close"), (30, 5, "repeated"), (25, 8, "steep")])
def test_jacobi_davidson(dimension, wanted, spectrum):
    rng = np.random.default_rng(3)
    values = {"close": 1 + 1e-3 * np.arange(dimension), "repeated": np.r_[[9.0] * 3, [4.0] * 4, np.ones(dimension - 7)],
              "steep": 10.0 ** -np.arange(dimension)}.get(spectrum) if isinstance(spectrum, str) else spectrum
    values = rng.random(dimension) if values is None else np.array(values, float)
    basis = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
    matrix = basis * values @ basis.T
    matrix = (matrix + matrix.T) / 2
    products = []
    got, vectors = jacobi_davidson(lambda p: products.append(p.shape[1]) or matrix @ p, dimension, wanted)
    assert got == pytest.approx(np.sort(values)[::-1][:wanted], abs=1e-13 * values.max())
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-12 * values.max()
    assert max(products) <= wanted + whitening.GUARD  # blocks, never the whole matrix


def test_whitening_on_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    source = table.orderBy("vec_id").collect()
    rows = op11_whitening(spark, SF).collect()
    check_whitening(rows, [r["vec_id"] for r in source], [r["embedding"] for r in source])


def test_whitening_edges(spark):
    rng = random.Random(5)
    good = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(40)]
    good += [good[0]] * 30 + [[1000.0, 0.0, 0.0, 0.0, 0.0]]
    bad = [None, [1.0, None, 0.0, 0.0, 0.0], [1.0, float("nan"), 0.0, 0.0, 0.0], [float("inf"), 1.0, 0.0, 0.0, 0.0], [], [1.0, 2.0], [1e300] * 5]
    rows = [(i, v, "x") for i, v in enumerate(good)] + [(1000 + i, v, "y") for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")
    check_whitening(whitening_report(frame).collect(), list(range(len(good))), good)
    # repeated rows and null ids come as often as they are there
    repeated = spark.createDataFrame([(7, good[1]), (7, good[1]), (None, good[2]), (3, good[3])], "vec_id long, embedding array<double>")
    got = Counter(r["vec_id"] for r in whitening_report(repeated).where("component = 1").collect())
    assert got == {7: 2, None: 1, 3: 1}
    # nothing, or no variance: no components
    assert fit_whitening(frame.where("vec_id >= 1000 and vec_id <> 1005")) is None
    for none in (frame.limit(0), frame.where("vec_id = 1"), frame.where("vec_id >= 1000 and vec_id <> 1005")):
        assert whitening_report(none).collect() == []


# -------------------------------------------------------------- language identification


def plain_language(rows):
    """Predictions for (id, text, lang) rows by dictionaries of words and n-grams."""
    def words(text):
        return ["".join(c.lower()[0] for c in w) for w in re.findall(r"[^\W\d_]+", text or "")]

    def grams(word, k):
        padded = [None, *word, None]
        return [tuple(padded[i:i + k]) for i in range(len(padded) - k + 1)]

    def held(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 4 == 2

    learn = [(t, lang) for i, t, lang in rows if not held(i) and lang is not None]
    shares = Counter(lang for _, lang in learn)
    langs = sorted(shares)
    counts = {k: {lang: Counter() for lang in langs} for k in (0, *language_id.ORDERS)}
    for text, lang in learn:
        for w in words(text):
            counts[0][lang][w] += 1
            for k in language_id.ORDERS:
                counts[k][lang].update(grams(w, k))
    logs = {}
    for k, own in counts.items():
        total = sum(own.values(), Counter())
        known = [f for f, n in total.items() if n >= language_id.LEAST_COUNT]
        size = [sum(own[lang][f] for f in known) for lang in langs]
        logs[k] = {f: [math.log((own[lang][f] + .5) / (size[j] + .5 * len(known))) for j, lang in enumerate(langs)] for f in known}
    out = []
    for i, text, _ in rows:
        if not langs or not words(text):
            out.append((i, held(i), "und", 0.0))
            continue
        scores = [math.log(shares[lang] / len(learn)) for lang in langs]
        for w in words(text):
            found = [logs[0][w]] if w in logs[0] else []
            for k in language_id.ORDERS:
                if not found:
                    found = [logs[k][g] for g in grams(w, k) if g in logs[k]]
            for f in found:
                scores = [s + x / len(found) for s, x in zip(scores, f)]
        odds = [math.exp(s - max(scores)) for s in scores]
        out.append((i, held(i), langs[scores.index(max(scores))], max(odds) / sum(odds)))
    return out


def test_language_against_plain(spark):
    source = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    source += [(9001, None, "en"), (9002, "", None), (9003, "123 ... 45!", "fr"), (None, "le la les", None), (9004, "x" * 300_000, None),
               (9005, "日本語 と 𝔘𝔫𝔦", None), (9006, "der die das", None), (9006, "der die das", None), (9007, "İstanbul Œuvre", "zz")]
    frame = spark.createDataFrame(source, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).withColumn("held", F.lit(1))
    got = sorted((tuple(r) for r in identify_language(frame).collect()), key=repr)
    want = sorted(plain_language(source), key=repr)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-4)


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op12_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", F.col("text").rlike(r"\p{L}").alias("lettered")), "doc_id")
    right = rows.where("held_out and lettered").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    assert rows.where("score < 0 or score > 1 or score is null").isEmpty()


def test_language_nothing_to_learn(spark):
    frame = spark.createDataFrame([(1, "one two", None), (2, None, None)], "doc_id long, text string, lang string")
    assert sorted(tuple(r)[2:] for r in identify_language(frame).collect()) == [("und", 0.0)] * 2
    assert identify_language(frame.limit(0)).collect() == []


def test_language_tables_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "CELLS", 400)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    languages = sorted(r[0] for r in docs.select("lang").distinct().collect())
    counts = language_id.feature_counts(docs.select("text", "lang"), languages)
    tables = language_id._tables(counts, len(languages))
    assert sum(logs.size for _, logs in tables.values()) <= 400
    kept = counts.where("kind = 0").orderBy(F.desc("total")).collect()
    features = set(np.asarray(tables[0][0]).view(np.int64).tolist())
    least = min(r["total"] for r in kept if r["feature"] in features)
    assert all(r["feature"] in features for r in kept if r["total"] > least)


# --------------------------------------------------------------------------- spelling


def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near, shared = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            less = w[:i] + w[i + 1:]
            shared[i, less].add(w)
            if less in n:
                near[w].add(less), near[less].add(w)
    for same in shared.values():
        for w in same:
            near[w] |= same - {w}
    best = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: b if b is not None and n[b] >= 5 * n[w] else None for w, b in best.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n), key=repr)


def variants(frame):
    return sorted((tuple(r) for r in spelling_variants(frame).collect()), key=repr)


def test_variants_on_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op13_spelling_variants(spark, sf).collect()), key=repr)
    assert got == plain_variants(rows) and sum(r[1] is not None for r in got) > 100


def test_variants_edges(spark):
    rng = random.Random(11)
    stems = ["".join(rng.choice("abcdeéÀÿz") for _ in range(rng.randrange(6, 11))) for _ in range(60)]
    words = list(stems)
    for w in stems:
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice("abcéÿ")
            words.append(rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i + 1:], w[:i] + c + w[i:], w + c]))
    rows = [(i, " ".join(rng.choice(words if rng.random() < .4 else stems[:20]) for _ in range(60))) for i in range(300)]
    # a chain of forms, equal neighbours, runs cut by signs, case, nulls, one very long run and one very long text
    rows += [(None, "chainab " * 5 + "chainac " * 26 + "chainbc " * 140 + "Chainbd-CHAINBD×7"), (None, "tieword " * 6 + "tieworda " * 40 + "tiewordb " * 40)]
    rows += [(5, None), (6, ""), (None, None), (7, "Éclairs éclairs ÉCLAIRS " * 9), (8, "q" * 50_000 + " "), (9, ("longlong " * 300 + "\n") * 500)]
    rows += [(8, "q" * 50_000 + " ")] * 4 + [(10, "q" * 50_001)] * 5
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    assert variants(frame) == plain_variants(rows)
    assert variants(frame.limit(0)) == []


def test_variants_full_bitmap(spark, monkeypatch):
    """With a bitmap that drops nothing, the join alone decides."""
    rows = [(w, 5) for w in ("kitten", "sitten", "kittens", "kitte", "mitten", "sitting", "ab", "a")]
    frame = spark.createDataFrame(rows, "word string, n long")

    def pairs():
        return {(r["word"], r["near"]) for r in near_words(frame).collect()}

    found = pairs()
    monkeypatch.setattr(spelling, "_bitmap", lambda keys: np.full(1 << (spelling.BITMAP_BITS - 6), ~np.uint64(0)))
    assert found == pairs() == {(a, b) for x in [("kitten", "sitten"), ("kitten", "kittens"), ("kitten", "kitte"), ("kitten", "mitten"),
                                                 ("sitten", "mitten"), ("ab", "a")] for a, b in (x, x[::-1])}


def test_neighbourhood_is_full():
    """Keys of a word's neighbours are those of the reduced forms of all its one-edit neighbours."""
    letters = "abcdefghijklmnopqrstuvwxyzàéÿ"
    word = "lantern"
    near = {word[:i] + c + word[j:] for i in range(len(word) + 1) for c in [*letters, ""] for j in (i, i + 1) if j <= len(word)}
    _, keys = spelling._Sums(pa.array([word])).neighbours()
    own = {spelling.mix64(spelling._Sums(pa.array([w])).total)[0] for w in near}
    assert own <= set(keys.tolist())
    assert len(set(keys.tolist())) <= 1 + len(word) + spelling.SYMBOLS * (2 * len(word) + 1)
