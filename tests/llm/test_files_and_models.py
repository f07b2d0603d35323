"""Mixing, sharding, WARC, token files, page extraction and the language model."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from foldline.llm import gru, language_model, warc  # noqa: E402
from foldline.llm.common import scratch  # noqa: E402
from foldline.llm.language_model import score_documents  # noqa: E402
from foldline.llm.mixing import mix_documents, mix_report, source_targets  # noqa: E402
from foldline.llm.sharding import place_arcs, ring, shard_documents, shard_report  # noqa: E402
from foldline.llm.simple8b import decode, encode  # noqa: E402
from foldline.llm.site_tree import extract_main_text, main_text  # noqa: E402
from foldline.llm.token_files import Encoder, default_tokenizer, read_token_files, token_round_trip, write_token_files  # noqa: E402

# ------------------------------------------------------------------------ mixing


def targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeating the sharing until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        share = sum(weight[s] for s in order if s not in stopped)
        over = {s for s in order if s not in stopped and weight[s] * rest / share > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in stopped else weight[s] * rest / share for s in order}
        stopped |= over


def test_source_targets(spark):
    rng = random.Random(1)
    for _ in range(4):
        sizes = {s: rng.randrange(0, 10 ** rng.randrange(1, 7)) for s in ["b", "a", "é", "Z", None, "c"][: rng.randrange(2, 7)]}
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in source_targets(frame, (5, 2, 1), 3).collect()}
        assert got == pytest.approx(targets(sizes))


def mixing_rows():
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(None, "x y z", "b"), (None, None, "c"), (7, rows[7][1], rows[7][2]), (7, rows[7][1], rows[7][2]), (900, "q " * 3000, "a")]
    return rows


def test_mix_takes_targets_and_reruns_agree(spark):
    rows = mixing_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("rank", F.lit("clash"))
    first = sorted(map(tuple, mix_report(docs).collect()), key=repr)
    assert first == sorted(map(tuple, mix_report(docs.repartition(5)).collect()), key=repr)
    assert len(first) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    want, taken, longest = targets(dict(sizes)), Counter(), Counter()
    names = {(i, len(brute.words(t))): s for i, t, s in rows}
    for i, size, source_size, target, took in first:
        assert took in (0, size, 2 * size, 3 * size)
        if i is not None:
            source = names[i, size]
            assert source_size == sizes[source] and target == pytest.approx(want[source])
            longest[source] = max(longest[source], size)
            taken[source] += took
    for source, goal in want.items():
        # each source stops within a document of its target; what they leave goes on in finish order
        assert abs(taken[source] - goal) <= sum(longest.values()) + 3
    assert sum(t[4] for t in first) <= sum(sizes.values())
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r["doc_id"] for r in mixed.collect())
    for i, size, _, _, took in first:
        if i not in (None, 7):
            assert copies[i] == (took // size if size else 0)


def test_mix_of_repeated_rows_comes_near_its_targets(spark, monkeypatch):
    """A source of one row six hundred times, null id included, is taken copy by copy."""
    from foldline.llm import mixing

    monkeypatch.setattr(mixing, "COPIES_TOGETHER", 50)
    rows = [(None, "a b c d", "x", i % 3) for i in range(600)]
    rows += [(i, f"w{i} of y and", "y", i) for i in range(100)] + [(i, f"w{i} of z and", "z", i) for i in range(100, 200)]
    rows += [(i, f"w{i} of n and", None, i) for i in range(200, 250)] + [(900, "n n n n", None, 5)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other int").repartition(6)
    report = mix_report(docs).collect()
    assert len(report) == len(rows)
    assert sorted(map(tuple, report), key=repr) == sorted(map(tuple, mix_report(docs.repartition(2)).collect()), key=repr)
    goals = targets({"x": 2400, "y": 400, "z": 400, None: 400})
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    for r in mixed.collect():
        got[r["source"]] += 4
        assert r["other"] in {o for i, _, s, o in rows if (i, s) == (r["doc_id"], r["source"])}
    for source, goal in goals.items():
        assert abs(got[source] - goal) <= 4 * 4
    taken = Counter()
    for r in report:
        taken[r["source_size"], r["target"]] += r["taken"]
    for (_, goal), n in taken.items():
        assert abs(n - goal * sum(g == pytest.approx(goal) for g in goals.values())) <= 4 * 8
    # no row more than three times, and of equal rows about as many of each kind
    most = Counter((r["doc_id"], r["text"], r["source"], r["other"]) for r in mixed.collect())
    given = Counter(rows)
    assert all(n <= 3 * given[k] for k, n in most.items())


def test_mix_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_report(empty).collect() == [] == mix_documents(empty).collect()
    silent = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert sorted(r["taken"] for r in mix_report(silent).collect()) == [0, 0]
    assert mix_documents(silent).collect() == []


# ---------------------------------------------------------------------- sharding


def test_place_arcs_fills_every_shard_exactly():
    rng = random.Random(3)
    for _ in range(20):
        shards = rng.randrange(1, 9)
        owners = [s for _, s in ring(shards, 7)]
        counts = [rng.randrange(0, 30) for _ in owners]
        counts[rng.randrange(len(counts))] += sum(counts)  # one arc holds half of all keys
        total = sum(counts)
        capacity = [total // shards + (s < total % shards) for s in range(shards)]
        segments = place_arcs(counts, owners, capacity)
        slots = {s: [] for s in range(shards)}
        seen = {a: [] for a in range(len(counts))}
        for arc, start, end, shard, slot in segments:
            seen[arc] += range(start, end)
            slots[shard] += range(slot, slot + end - start)
        assert all(seen[a] == list(range(n)) for a, n in enumerate(counts))
        assert all(sorted(slots[s]) == list(range(capacity[s])) for s in range(shards))
        assert len(segments) <= len(counts) + shards


def test_shards_are_balanced_gapless_and_move_little(spark):
    rng = random.Random(4)
    texts = [f"text {rng.randrange(150)}" for _ in range(700)] + ["hot"] * 400 + [None, "", "é"] * 5
    docs = spark.createDataFrame([(i if i % 97 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.withColumn("slot", F.lit("old")).withColumn("_cell", F.lit(1))
    placed = shard_documents(docs, 7)
    assert sorted(placed.columns) == sorted([*docs.columns, "shard"])
    slots = {}
    for r in placed.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(v) for v in slots.values()]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1 and len(slots) == 7
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    rows = shard_report(docs.repartition(3), 7).collect()
    for r in rows[:50]:
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert Counter(r["text_crc32"] for r in rows) == Counter(zlib.crc32((t or "").encode()) for t in texts)
    assert Counter(r["size"] for r in rows) == Counter(len((t or "").encode()) + 16 for t in texts)
    unique = spark.createDataFrame([(i, f"own {i}") for i in range(3000)], "doc_id long, text string")
    a, b = ({r["doc_id"]: r["shard"] for r in shard_report(unique, n).collect()} for n in (10, 11))
    assert sum(a[i] != b[i] for i in a) < 0.35 * len(a)
    assert shard_documents(docs.limit(0), 7).collect() == []


# -------------------------------------------------------------------------- WARC


def pages():
    fake = warc.record_bytes(7, "http://x/", b"evil", hashlib.sha256(b"evil").hexdigest()).decode()
    return [(1, "http://a/", fake), (2, None, None), (3, "http://b/ ü\r\nX: y", "ü" * 200), (4, "http://b", "ü" * 200),
            (None, "q", "ü" * 200), (5, "z", ""), (6, "zz", "x" * 99), (8, "zz", "x" * 99), (9, "l", fake * 3 + "\r\n"),
            (10, "p", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 20 + "\r"), (11, "big", "y" * 9000 + fake)]


@pytest.mark.parametrize("compress", [True, False])
def test_warc_round_trip_rejects_records_in_payloads(spark, monkeypatch, compress):
    monkeypatch.setattr(warc, "RANGE_BYTES", 700)
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    frame = spark.createDataFrame(pages(), "page_id long, url string, html string").withColumn("digest", F.lit(1))
    path = scratch(spark, "warc-test")
    manifest = warc.write_warc(frame, path, compress)
    files = warc.list_archives(spark, path)
    assert sorted(map(tuple, files.collect())) == sorted(map(tuple, manifest.select("file", "bytes").collect()))
    rows = {r["page_id"]: r for r in warc.read_warc(spark, path, files).collect()}
    assert len(rows) == len(pages())
    for page_id, _, html in pages():
        data, r = (html or "").encode(), rows[page_id]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        twin = page_id in (4, None)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if twin else ("response", None))
        assert bytes(r["payload"]) == (b"" if twin else data)
    candidates = sum(len(warc.range_candidates(f"{path}/{f['file']}", f["bytes"], 0, f["bytes"])) for f in files.collect())
    assert candidates >= len(pages()) + (0 if compress else 20)


def test_warc_damage_is_noticed_and_empty_is_empty(spark, tmp_path):
    good = warc.record_bytes(1, "u", b"a" * 50, hashlib.sha256(b"a" * 50).hexdigest())
    (tmp_path / "broken.warc").write_bytes(good + good[:-9])
    files = spark.createDataFrame([("broken.warc", 2 * len(good) - 9)], "file string, bytes long")
    with pytest.raises(ValueError, match="unbroken"):
        warc.read_warc(spark, str(tmp_path), files).collect()
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.warc_round_trip(empty).collect() == []


# ------------------------------------------------------------------- token files


def test_simple8b_round_trips_with_escapes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 255, 256, 257, 5000):
        for top in (1, 2, 40, 300, 50257, 2 ** 33, 2 ** 60, 2 ** 63):
            values = (rng.random(n) ** 4 * top).astype(np.uint64)
            if n > 300:
                values[[3, 256, 290]] = 2 ** 64 - 1, 2 ** 60, 2 ** 60 - 1
            words, first, exceptions = encode(values)
            assert (decode(words, first, exceptions, n) == values).all()
            assert len(words) <= max(1, n)


def test_encoder_equals_the_library():
    encoder = Encoder(default_tokenizer())
    rng = random.Random(3)
    alphabet = list("ab1'.,\n\t\r é") + ["  ", " ", " ", "\x1c", "\x85", "'s", "日本", "　"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(3000)]
    texts += ["", " ", "x <|endoftext|> y", "don't  we'll x", "a\n  b"]
    ids, sizes = encoder.encode(texts)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    for i, e in enumerate(encoder.library.encode_batch(texts, add_special_tokens=False)):
        assert list(ids[edges[i]: edges[i + 1]]) == e.ids + [0], repr(texts[i])


def test_columns_are_encoded_as_texts_are(monkeypatch):
    """Simple texts, others between them, pieces met again, and a cache that is emptied on the way."""
    import pyarrow as pa

    from foldline.llm import token_files

    monkeypatch.setattr(token_files, "CACHE_ENTRIES", 300)
    rng = random.Random(9)
    alphabet = list("aB1.;\n é") + [" ", " the", " of", "ß", "12", "--", " x"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 25))) for _ in range(3000)]
    texts += ["", " ", "\n", "a ", " a", "it's", "a  b", "x <|endoftext|> y", "日本", "tab\there", "long " * 9000, "w" * 5000]
    rng.shuffle(texts)
    encoder, plain = Encoder(default_tokenizer()), Encoder(default_tokenizer())
    assert encoder.by_piece
    for a in range(0, len(texts), 400):
        ids, sizes = encoder.encode_column(pa.array(["before", *texts[a: a + 400]]).slice(1))
        want, lengths = plain.encode(texts[a: a + 400])
        assert (ids == want).all() and (sizes == lengths).all()
    edges = np.concatenate([[0], np.cumsum(sizes)])
    for i, e in enumerate(encoder.library.encode_batch(texts[a: a + 400], add_special_tokens=False)):
        assert list(ids[edges[i]: edges[i + 1]]) == e.ids + [0]
    for none in ([], ["", ""], ["日本"]):
        ids, sizes = encoder.encode_column(pa.array(none, pa.string()))
        assert len(sizes) == len(none) and len(ids) == sizes.sum()


def test_token_files_in_id_order(spark, monkeypatch):
    from foldline.llm import token_files

    monkeypatch.setattr(token_files, "FILE_IDS", 500)
    monkeypatch.setattr(token_files, "SLICE_BYTES", 2000)
    rng = random.Random(5)
    rows = [(rng.randrange(10 ** 9), " ".join(rng.choice(["the", "ñandú", "x\ny", "42"]) for _ in range(rng.randrange(60)))) for _ in range(150)]
    rows += [(None, "no id"), (5, None), (5, "five"), (5, "five"), (6, "long " * 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumn("file", F.lit("clash"))
    path = scratch(spark, "tokens-test")
    manifest = write_token_files(docs, path)
    assert manifest.count() > 3
    got = sorted(map(tuple, read_token_files(spark, path, manifest).collect()), key=lambda r: r[1])
    encoder, start = Encoder(default_tokenizer()), 0
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    left = Counter()
    for i, text in rows:
        ids = encoder.library.encode(text or "", add_special_tokens=False).ids + [0]
        left[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    for i, at, n, crc in got:
        assert at == start
        start += n
        left[i, n, crc] -= 1
    assert not +left and start == manifest.agg(F.sum("ids")).first()[0]
    assert token_round_trip(docs.limit(0)).collect() == []


# --------------------------------------------------------------- page extraction


def test_markup_rules():
    page = """<html><head><title>T</title><style>a{}</style></head><body><header><h1>Site</h1></header><nav>menu</nav>
      <div class="sidebar">side</div><main><h1>Head &amp; line</h1><p>One <b>two</b><span class="ad">BUY</span> three<br>four
      <p>Five <script>x</p></script> six<!-- no --><ul><li>a<li>b&#33;</ul><form><input>zz</form><table><tr><td>c1<td>c2</table>
      <div id="comments">cc</div></main><footer>f</footer>"""
    assert main_text(page, set()) == "\n\n".join(["Head & line", "One two three four", "Five six", "a", "b!", "c1", "c2"])
    assert main_text("a < b <p>x &lt;y&gt; <div>q</div>tail<script>abc", set()) == "a < b\n\nx <y>\n\nq\n\ntail"
    assert main_text("", set()) == "" == main_text("<nav>x</nav><!-- y", set())


def test_site_tree_removes_repeated_branches(spark):
    words = ["alpha", "beta", "gamma", "delta"]

    def page(i):
        return (f'<body><div class="top">Our Site of Things</div><div class="story"><p>{words[i % 4]} story {i} ' + f"body{i} " * 20
                + f'</p><p>{"more " * (i + 1)}</p></div><div class="imprint">All rights kept</div></body>')

    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(12)] + [(20, "http://single.example/", page(3)), (21, None, None), (22, "x", "")]
    rows += [(30 + k, "http://h.example/same", page(1)) for k in range(4)]  # copies count once
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r["text"] for r in extract_main_text(frame).collect()}
    assert len(got) == len(rows) and got[21] == got[22] == ""
    for i in range(12):
        assert got[i].startswith(f"{words[i % 4]} story {i} ") and "rights" not in got[i] and "Our Site" not in got[i]
    assert "rights" in got[20]  # one page shows no template
    assert got[30] == got[1]
    assert extract_main_text(frame.limit(0)).collect() == []


def test_articles_are_read_whole(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in extract_main_text(frame).collect()}
    import html
    for r in frame.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in re.split(r"</?p>|</?h1>", article)]
        assert got[r["page_id"]]["text"] == "\n\n".join(p for p in parts if p)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


# ---------------------------------------------------------------- language model


def test_gradients_and_probabilities():
    rng = np.random.default_rng(0)
    model = gru.new_model(rng.integers(1, 100, 40), classes=6, hidden=5)
    for k in ("V", "W"):
        model[k] = rng.standard_normal(model[k].shape) * 0.3
    model = {k: v.astype(np.float64) if k != "class" else v for k, v in model.items()}
    groups, ids = gru.members(model), rng.integers(0, 40, 60)
    targets = np.stack([ids[0:7], ids[20:27], ids[35:42]], 1)
    inputs = np.concatenate([[[3, 3, 3]], targets[:-1]])
    mask = np.ones((7, 3), bool)
    mask[4:, 1] = False
    state = rng.standard_normal((3, 5)) * 0.2
    _, grads, _ = gru.gradients(model, groups, inputs, targets, mask, state)
    for k in gru.PARAMETERS:
        for _ in range(4):
            at = tuple(int(rng.integers(0, s)) for s in model[k].shape)
            at = (int(targets[0, 0]), *at[1:]) if k in ("W", "w", "X") else at
            old, sums = model[k][at], []
            for step in (1e-5, -1e-5):
                model[k][at] = old + step
                sums.append(gru.gradients(model, groups, inputs, targets, mask, state)[0])
            model[k][at] = old
            assert grads[k][at] == pytest.approx(-(sums[0] - sums[1]) / 2e-5, rel=1e-4, abs=1e-5)
    first = np.array([0, 20, 35, 35, 60])
    scores = gru.score(model, ids, first, 3, lanes=2, window=4)
    for d in range(4):
        h, previous, total = np.zeros((1, 5)), 3, 0.0
        for x in ids[first[d]: first[d + 1]]:
            h = gru._step(model, np.array([previous]), h)[0]
            total += gru._output(model, groups, h, np.array([x]))[0][0]
            previous = x
        assert scores[d] == pytest.approx(total, abs=1e-3)
    h = rng.standard_normal((1, 5))
    assert sum(math.exp(gru._output(model, groups, h, np.array([x]))[0][0]) for x in range(40)) == pytest.approx(1)


def test_training_learns_what_a_unigram_cannot():
    rng = np.random.default_rng(1)
    ids = np.concatenate([np.append(np.tile([2, 3, 4, 5], rng.integers(2, 12)), 0) for _ in range(400)])
    first = np.concatenate([[0], np.flatnonzero(ids == 0) + 1])
    model = gru.new_model(np.bincount(ids, minlength=8), classes=3, hidden=8)
    before = gru.score(model, ids, first, 0).sum()
    model, _ = gru.train(model, ids, first, 0, lanes=8, window=8)
    assert gru.score(model, ids, first, 0).sum() > 0.5 * before


def test_base_scores_and_held_out_gain(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["Alpha", "beta", "gamma", f"rare{rng.randrange(500)}"] * rng.randrange(1, 30))) for i in range(300)]
    rows += [(None, "alpha"), (400, None), (401, "unseen words only"), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    got = score_documents(docs.repartition(3)).collect()
    assert len(got) == len(rows)
    counts, tokens = Counter(), {}
    for i, text in rows:
        tokens[i] = brute.words(text) + [None]
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update(tokens[i])
    n, v = sum(counts.values()), len(counts)
    for r in got:
        own = tokens[r["doc_id"]]
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[t] > 0 for t in own), n)
        assert r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 7 == 2)
        assert r["score"] < 0
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > 1.02 * sum(r["base_score"] for r in held)
    assert score_documents(docs.limit(0)).collect() == []


def test_network_learns_from_every_training_row(spark, monkeypatch):
    rows = [(i, f"one two three four own{i} " * (2 + i % 5)) for i in range(40)] + [(None, "one two"), (41, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, train_pass = [], language_model._train_pass

    def noted(texts, shared, model):
        trained = train_pass(texts, shared, model)
        seen.append((texts.collect(), model, trained))
        return trained

    monkeypatch.setattr(language_model, "_train_pass", noted)
    monkeypatch.setattr(language_model, "TRAIN_TOKENS", 50)
    got = score_documents(docs.repartition(3)).collect()
    want = [i for i, _ in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    assert [sorted((r["id"] for r in read), key=repr) for read, _, _ in seen] == [sorted(want, key=repr)]
    assert not np.allclose(seen[0][1]["W"], seen[0][2]["W"])
    assert len(got) == len(rows)


def test_training_reads_every_token(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 70, 50)
    first = np.append(0, np.cumsum(lengths))
    ids = rng.integers(1, 12, first[-1])
    read, gradients = [], gru.gradients

    def noted(model, groups, inputs, targets, mask, h0):
        read.extend(targets[mask])
        return gradients(model, groups, inputs, targets, mask, h0)

    monkeypatch.setattr(gru, "gradients", noted)
    gru.train(gru.new_model(np.bincount(ids, minlength=12), classes=3, hidden=4), ids, first, 0, lanes=8, window=8)
    assert Counter(read) == Counter(ids)


def test_a_long_text_is_not_scored_window_by_window(monkeypatch):
    """The class layer is computed for many steps of a long text at once; its score stays the same."""
    rng = np.random.default_rng(5)
    first = np.append(0, np.cumsum([3000] + [20] * 300))
    ids = rng.integers(0, 12, first[-1])
    model = gru.new_model(np.bincount(ids, minlength=12), classes=3, hidden=4)
    model["W"] += rng.standard_normal(model["W"].shape).astype(np.float32)
    calls, output = [], gru._output

    def noted(model, groups, hidden, target, *more):
        calls.append(len(target))
        return output(model, groups, hidden, target, *more)

    monkeypatch.setattr(gru, "_output", noted)
    scores = gru.score(model, ids, first, 0)
    assert sum(calls) == len(ids) and len(calls) < 10
    assert scores[0] == pytest.approx(gru.score(model, ids[:3000], first[:2], 0)[0], rel=1e-6)


def test_inputs_of_a_long_text_are_gathered_for_many_steps(monkeypatch):
    """where one long text remains, its inputs are gathered by windows, not step by step."""
    rng = np.random.default_rng(8)
    first = np.append(0, np.cumsum([3000] + [20] * 30))
    ids = rng.integers(0, 12, first[-1])
    model = gru.new_model(np.bincount(ids, minlength=12), classes=3, hidden=4)
    model["W"] += rng.standard_normal(model["W"].shape).astype(np.float32)
    read, inputs = [], gru._inputs

    def noted(x, previous):
        read.append(previous.size)
        return inputs(x, previous)

    monkeypatch.setattr(gru, "_inputs", noted)
    scores = gru.score(model, ids, first, 0)
    assert sum(read) == len(ids) and len(read) < 200
    h, previous, total = np.zeros((1, 4), np.float32), 0, 0.0
    for x in ids[:3000]:
        h = gru._step(model, np.array([previous]), h)[0]
        total += gru._output(model, gru.members(model), h, np.array([x]))[0][0]
        previous = x
    assert scores[0] == pytest.approx(total, rel=1e-6)


def test_a_small_window_changes_few_rows():
    """a window names the ids that have a gradient; all others have none."""
    rng = np.random.default_rng(9)
    model = gru.new_model(rng.integers(1, 100, 500), classes=20, hidden=5)
    for k in ("V", "W"):
        model[k] = rng.standard_normal(model[k].shape).astype(np.float32)
    targets = rng.integers(0, 500, (4, 1))
    inputs = np.concatenate([[[1]], targets[:-1]])
    _, grads, _ = gru.gradients(model, gru.members(model), inputs, targets, np.ones((4, 1), bool), np.zeros((1, 5), np.float32))
    for k in ("X", "W", "w"):
        rows = grads["rows"][k]
        assert 0 < len(np.unique(rows)) == len(rows) < 260
        assert set(np.flatnonzero(grads[k].reshape(500, -1).any(axis=1))) <= set(rows)


def test_lookups_by_leading_bits():
    """words are found by their leading bits, also where many words have equal ones."""
    rng = np.random.default_rng(10)
    near = np.arange(50, dtype=np.uint64) * np.uint64(3) + np.uint64(7 << 60)
    ends = np.array([0, 2**64 - 1], np.uint64)
    for words in (near[:0], near[:1], ends, near, np.concatenate([near, ends, rng.integers(0, 2**64, 3000, np.uint64)])):
        words = np.unique(words)
        shared = {"words": words, "starts": language_model._by_bits(words), "logs": np.ones(len(words)), "ids": np.arange(len(words), dtype=np.int32)}
        asked = np.concatenate([words, words + np.uint64(1), words - np.uint64(1), rng.integers(0, 2**64, 100, np.uint64)])
        place = {w: i for i, w in enumerate(words.tolist())}
        assert language_model._Table(shared)(asked).tolist() == [place.get(w, -1) for w in asked.tolist()]


def test_scores_do_not_depend_on_parts_or_copies(spark, monkeypatch):
    """F1: parts are encoded one by one and scored together; each copy of a row has the row's sums."""
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(60))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])] * 2 + [(None, None)] * 3 + [(None, "w1 rare"), (500, "unseen")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def result():
        return sorted(((r["doc_id"] is None, r["doc_id"], *(r[c] for c in ("n_tokens", "n_known", "base_score", "score")))
                       for r in score_documents(docs).collect()), key=repr)

    monkeypatch.setattr(language_model, "FREQUENT", 10)  # so that the other words are joined
    want = result()
    monkeypatch.setattr(language_model, "ENCODE_BYTES", 300)
    assert len(want) == len(rows) and want[0][4] < 0
    for limit in (1000, 1 << 20):
        monkeypatch.setattr(language_model, "SCORE_BYTES", limit)
        for row, other in zip(want, result()):
            assert row[:4] == other[:4] and row[4:] == pytest.approx(other[4:], rel=1e-6)
    third = [r for r in want if r[1] == 3]
    assert len(third) == 3 and len(set(third)) == 1
    assert third[0][2] == len(texts[3].split()) + 1 >= third[0][3]


def test_names_of_surroundings_do_not_drop_the_article():
    body, noise = "<p>" + "the article goes on " * 6 + "</p>", "<p>" + "bad words " * 90 + "</p>"
    want = ("the article goes on " * 6).strip()
    for page in (
        f'<body class="has-sidebar">{body}</body>', f'<main class="content no-sidebar">{body}</main>',
        f'<article class="post comments-open">{body}</article>', f'<div id="menu-page">{body}</div>',
        f'<div class="page-menu"><article>{body}</article><div class="comments-area">{noise}</div></div>',
        f'<div id="comments" class="comments-area">{noise}</div>{body}', f'<div class="left-sidebar"><p>x</p></div>{body}',
        f'<div class="menu"><p>{"go " * 100}</p></div>{body}', f'<body class="menu"><div class="share">no</div>{body}</body>',
    ):
        assert main_text(page, set()) == want, page


def plain_placement(rows, shards, vnodes):
    """(shard, slot) of each (id, text) row, by walking the ring one row at a time."""
    from foldline.llm.sharding import CELL_BITS, SUB_BITS

    def key(*parts):
        return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:15], 16)

    points = ring(shards, vnodes)
    arcs = [[] for _ in points]
    for n, (i, text) in enumerate(rows):
        digest = hashlib.md5((text or "").encode()).hexdigest()
        place, order = key("place", digest), key("order", "" if i is None else str(i), digest)
        cell = place >> (60 - CELL_BITS)
        arc = next((a for a, (end, _) in enumerate(points) if cell < end), 0)
        behind = cell >= points[-1][0]  # arc 0 begins behind the last point
        arcs[arc].append((not behind, cell, order >> (60 - SUB_BITS), place, order, n))
    free = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    used, placed = [0] * shards, {}
    waiting = {a: [n for *_, n in sorted(own)] for a, own in enumerate(arcs)}
    for hop in range(len(points) + 1):
        for arc in range(len(points)):
            shard = points[(arc + hop) % len(points)][1]
            while waiting[arc] and free[shard]:
                placed[waiting[arc].pop(0)] = (shard, used[shard])
                free[shard] -= 1
                used[shard] += 1
    return [placed[n] for n in range(len(rows))]


@pytest.mark.parametrize("shards,vnodes", [(5, 3), (40, 64)])
def test_shards_against_a_walk_of_the_ring(spark, shards, vnodes):
    rng = random.Random(12)
    rows = [(i, f"text {rng.randrange(200)}") for i in range(500)] + [(1000 + i, "hot") for i in range(300)] + [(2000, None), (2001, "")]
    rows += [(7, "again"), (7, "again"), (None, "again")]
    want, got = plain_placement(rows, shards, vnodes), {}
    for r in shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), shards, vnodes=vnodes).collect():
        got.setdefault((r["doc_id"], r["text"]), []).append((r["shard"], r["slot"]))
    expected = {}
    for row, place in zip(rows, want):
        expected.setdefault(row, []).append(place)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
