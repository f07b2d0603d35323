"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Which texts have word-shingle sets with a Jaccard similarity of at least ``threshold``?

1. One pass takes each text's distinct 5-word shingles (64-bit hashes), their number, a hashed bitmap
   and a digest of the set. Texts with one digest are one class; copies never multiply work.
2. Every class sends the shingles of its *prefix* (the first ``n - ceil(t n) + 1`` in one global
   order) to be grouped by shingle; two sets with a similarity of t or more share a prefix
   shingle, so no link is lost. Shingles that a sample has in several texts come last in that order,
   so that passages which many texts share fill few prefixes. Any order gives the same links.
3. A group is cut into tiles of sizes within a factor 1/t. Each tile pairs a few pivots with its
   other classes, which connects families of near copies without all their pairs. Groups
   of hot shingles, and others of more than BLOCK rows, are not held in a task: Spark counts
   them, folds groups of the same members, and joins members with pivots in cells.
4. Candidate pairs are bounded from above by the bit counts of hashed bitmaps, and survivors are
   verified by the exact intersection of their shingle arrays, which only their texts are cut into.
5. Groups whose classes are still in more than one component go to further passes, in tiles of two
   blocks with a bounded number of rows: bitmaps of all pairs from different components (sizes
   permitting) are compared in numpy. The first of these passes sends a spanning forest of the
   pairs that pass, by falling margin, so at most one pair a component; where that left out pairs
   and components remain apart, the last pass sends all pairs that pass and were not yet verified.

The 64-bit hashes make the result exact up to hash collisions (for n distinct shingles or texts,
n * n / 2**65 pairs are expected to collide).
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, batch_words, discard, keep, materialize, mix64, shingles, slices
from .components import connected_components, join_components

THRESHOLD = Fraction(3, 4)
WIDTH = 5
BLOCK = 4096
BITS_A_SHINGLE = 8
PIVOTS = 3
CELLS = 32
SAMPLE_OF = 4  # one text in so many shows which shingles are repeated
SAMPLED_SHINGLES = np.uint64(1 << 63)  # and of its shingles those below, which prefixes mostly come from
REPEATED_BITS = 26  # the bitmap of repeated shingles has a fixed size, whatever the corpus
HOT_IN_SAMPLE = 64
HOT_KEPT = 100_000
ROWS_A_FILE = 1 << 14  # of the table, for each file of a written step
LEAST_FILES = 4


def _set_digest(values: np.ndarray) -> int:
    """Order-free digest of a set of hashes: mixed, multiplied by odd factors in sorted order."""
    if not len(values):
        return 0
    with np.errstate(over="ignore"):
        order = np.arange(1, len(values) + 1, dtype=np.uint64)
        total = np.sum(mix64(values ^ mix64(order)), dtype=np.uint64)
        return int(mix64(np.array([total + np.uint64(len(values))], np.uint64)).view(np.int64)[0])


def _sets(column: pa.Array):
    for _, part in slices(column):
        values, first = shingles(batch_words(part), WIDTH)
        for i in range(len(first) - 1):
            yield np.unique(values[first[i]: first[i + 1]])


def _bitmap(values: np.ndarray) -> bytes:
    """Hashed bitmap of a set; its width is a power of two of at least BITS_A_SHINGLE bits a shingle."""
    bits = 1 << max(9, (BITS_A_SHINGLE * len(values) - 1).bit_length())
    flags = np.zeros(bits, bool)
    flags[(values & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def _prefix_length(n: int, threshold: Fraction) -> int:
    return n - math.ceil(threshold * n) + 1


def _order(source: DataFrame, threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(bitmap of repeated shingles, sorted hot shingles), from a sample of one text in SAMPLE_OF.

    Shingles that two or more different texts of the sample have are repeated, and come last in
    the global order. Of those in HOT_IN_SAMPLE or more, the HOT_KEPT most frequent (up to equal
    counts) are hot. Both only make groups smaller, or spread them: links do not depend on them."""
    picked = source.where(F.pmod(F.xxhash64("id", "text"), F.lit(SAMPLE_OF)) == 0)

    def run(batches):
        for batch in batches:
            distinct = {_set_digest(v): v[: np.searchsorted(v, SAMPLED_SHINGLES)] for v in _sets(batch.column(0)) if len(v)}
            if distinct:
                found, df = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(as_long(found)), pa.array(df)], ["token", "df"])

    counted = picked.select("text").mapInArrow(run, "token long, df long").groupBy("token").agg(F.sum("df").alias("df"))
    repeated = keep(counted.where("df > 1"))
    low = F.col("token").bitwiseAND(F.lit((1 << REPEATED_BITS) - 1))
    words = repeated.groupBy(F.shiftright(low, 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(token & 63 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (REPEATED_BITS - 6), np.uint64)
    bitmap[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    size = F.floor(F.log2("df") * 8).cast("int")
    hot, least, left = repeated.where(F.col("df") >= HOT_IN_SAMPLE), None, HOT_KEPT
    for row in hot.groupBy(size.alias("size")).count().orderBy(F.desc("size")).collect():
        left -= row["count"]
        if left < 0:
            break
        least = row["size"]
    tokens = [] if least is None else [r[0] for r in hot.where(size >= least).select("token").collect()]
    discard(repeated)
    return bitmap, np.sort(np.array(tokens, np.int64).view(np.uint64))


def _is_repeated(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    low = values & np.uint64((1 << REPEATED_BITS) - 1)
    set_bits = (bitmap[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1)
    return (set_bits == 1) & (values < SAMPLED_SHINGLES)


def _prefix_rows(source: DataFrame, threshold: Fraction, bitmap: np.ndarray, hot: np.ndarray) -> DataFrame:
    """One pass over the texts: (kind 0) row id, digest and size of each row, with the bitmap of each
    different set of a task; (kind 1; 2 for hot shingles) prefix shingle, digest and size of each
    different set of a task."""
    order = source.sparkSession.sparkContext.broadcast((bitmap, hot))

    def sent(parts):
        repeated, hot = order.value
        tokens, ids, sizes = (np.concatenate(p) for p in parts)
        kinds = np.ones(len(tokens), np.int32)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
            kinds[hot[at] == tokens] = 2
        return _prefix_batch(kinds, as_long(tokens), ids, sizes, pa.nulls(len(tokens), pa.binary()))

    def run(batches):
        repeated = order.value[0]
        seen = set()  # digests this task has sent: copies send their shingles once a task
        for batch in batches:
            tokens, ids, sizes, waiting = [], [], [], 0
            rows_digest, rows_size, rows_bitmap = [], [], []
            for values in _sets(batch.column(1)):
                n, digest = len(values), _set_digest(values)
                new = n > 0 and digest not in seen
                rows_digest.append(digest), rows_size.append(n), rows_bitmap.append(_bitmap(values) if new else None)
                if not new:
                    continue
                seen.add(digest)
                keep = _prefix_length(n, threshold)
                last = _is_repeated(repeated, values)
                if last.any():
                    values = np.concatenate([values[~last], values[last]])
                tokens.append(values[:keep]), ids.append(np.full(keep, digest)), sizes.append(np.full(keep, n))
                waiting += keep
                if waiting > 200_000:
                    yield sent((tokens, ids, sizes))
                    tokens, ids, sizes, waiting = [], [], [], 0
            if waiting:
                yield sent((tokens, ids, sizes))
            yield _prefix_batch(0, batch.column(0), rows_digest, rows_size, pa.array(rows_bitmap, pa.binary()))

    return source.mapInArrow(run, "kind int, token long, id long, n int, bitmap binary")


def _prefix_batch(kind, tokens, ids, sizes, bitmaps):
    tokens = tokens if isinstance(tokens, pa.Array) else pa.array(tokens)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.broadcast_to(kind, len(tokens)).astype(np.int32)), tokens, pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), bitmaps],
        ["kind", "token", "id", "n", "bitmap"])


def _runs(batches, most: int):
    """(rows, starts of groups) of whole groups of equal tokens, with each (token, id) once, from
    batches of (token, id, n) sorted by token and id. A group is carried across batches until it
    ends or has more than ``most`` rows; the rows of such a group come as they are, without starts."""
    rest, long = None, None
    for part in batches:
        if rest is not None:
            part = [np.concatenate([a, b]) for a, b in zip(rest, part)]
            rest = None
        if long is not None:
            end = int(np.searchsorted(part[0], long, "right"))
            if end:
                yield [p[:end] for p in part], None
            part = [p[end:] for p in part]
        if not len(part[0]):
            continue
        new = np.ones(len(part[0]), bool)
        new[1:] = (part[0][1:] != part[0][:-1]) | (part[1][1:] != part[1][:-1])
        part = [p[new] for p in part]
        starts = np.concatenate([[0], np.flatnonzero(part[0][1:] != part[0][:-1]) + 1])
        yield [p[: starts[-1]] for p in part], starts
        rest, long = [p[starts[-1]:] for p in part], None
        if len(rest[0]) > most:
            yield rest, None
            rest, long = None, rest[0][0]
    if rest is not None and len(rest[0]):
        yield rest, np.array([0, len(rest[0])])


def _stars(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of PIVOTS pivots with all members. Pivots are the ids of least hash, which
    are mostly the same in all groups that one family of texts shares."""
    ranked = np.argsort(mix64(ids.view(np.uint64)), kind="stable")
    pivots = ids[ranked[: min(len(ids) - 1, PIVOTS)]]
    a, b = np.repeat(pivots, len(ids)), np.tile(ids, len(pivots))
    keep = (a < b) | ((a > b) & ~np.isin(b, pivots))
    return a[keep], b[keep]


def _tiles(sorted_rows: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (kind 0: a, b) of each tile's pivots with its others, members (kind 1: key, id, n) of
    groups of three or more (equal members give equal keys), rows (kind 2: id, digest, n, bitmap), and
    what ``_large_groups`` takes (kind 3: token, id, n): hot shingles and groups above BLOCK rows."""
    up, down = threshold.numerator, threshold.denominator

    def out(kind, key, a, b, bitmaps=None):
        key = key if isinstance(key, pa.Array) else pa.array(key)
        bitmaps = pa.nulls(len(key), pa.binary()) if bitmaps is None else bitmaps
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), kind, np.int32)), key, pa.array(a, pa.int64()), pa.array(b, pa.int64()), bitmaps],
            ["kind", "key", "a", "b", "bitmap"])

    most = BLOCK

    def run(batches):
        passed = []

        def grouped():
            for batch in batches:
                own = batch.column(0).to_numpy()
                rows = int(np.searchsorted(own, 1))
                if rows:
                    part = batch.slice(0, rows)
                    passed.append(out(2, part.column(1), part.column(2), part.column(3).cast(pa.int64()), part.column(4)))
                single = int(np.searchsorted(own, 2))
                if single < len(own):
                    part = batch.slice(single)
                    passed.append(out(3, part.column(1), part.column(2), part.column(3).cast(pa.int64())))
                part = batch.slice(rows, single - rows)
                yield [part.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)]

        for part, starts in _runs(grouped(), most):
            yield from passed
            passed.clear()
            if starts is None:
                yield out(3, part[0], part[1], part[2].astype(np.int64))
                continue
            pairs, members = [], []
            lengths, (_, all_ids, all_sizes) = np.diff(starts), part
            two = starts[:-1][lengths == 2]
            if len(two):
                low = np.minimum(all_sizes[two], all_sizes[two + 1]).astype(np.int64)
                high = np.maximum(all_sizes[two], all_sizes[two + 1]).astype(np.int64)
                two = two[low * down >= high * up]
                pairs.append(np.stack([all_ids[two], all_ids[two + 1]]))
            for s in np.flatnonzero(lengths > 2):
                ids, sizes = all_ids[starts[s]: starts[s + 1]], all_sizes[starts[s]: starts[s + 1]].astype(np.int64)
                order = np.lexsort((ids, sizes))
                by_size, by_id, at = sizes[order], ids[order], 0
                while at < len(ids):
                    end = int(np.searchsorted(by_size, by_size[at] * down // up, "right"))
                    if end - at > 1:
                        pairs.append(np.stack(_stars(by_id[at:end])))
                    at = end
                key = np.full(len(ids), _set_digest(ids.view(np.uint64)))
                members.append(np.stack([key, ids, sizes]))
            if pairs:  # one family's shingles give the same pairs and members again and again
                found = np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1)
                yield out(0, np.zeros(found.shape[1], np.int64), *found)
            if members:
                yield out(1, *np.unique(np.concatenate(members, axis=1), axis=1))
        yield from passed

    return sorted_rows.mapInArrow(run, "kind int, key long, a long, b long, bitmap binary")


def _large_groups(large: DataFrame, threshold: Fraction, files: int) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b), members (key, id, n)) of the groups of ``large`` (token, id, n), as of ``_tiles``.

    Groups of the same members are folded to one. Members are banded by size; pivots are the least
    ids (digests, so in random order) of a band and the band below, out of the minima of CELLS
    cells. Members meet the pivots cell by cell, so no task holds a group, nor a band's members."""
    step = math.log(threshold.denominator / threshold.numerator)
    rows = materialize(
        large.distinct().withColumn("band", F.floor(F.log("n") / step)).withColumn("cell", F.pmod("id", F.lit(CELLS))), "ngram-large", files)
    same = (
        rows.groupBy("token").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("x"),
                                  F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
        .where("m > 1").groupBy("m", "x", "y").agg(F.min("token").alias("token"))
        .select("token", F.xxhash64("m", "x", "y").alias("key"))
    )
    cells = rows.groupBy("token", "band", "cell").agg(F.min("id").alias("id"))
    cells = materialize(cells.join(same.hint("merge"), "token"), "ngram-cells", files)
    bands = cells.groupBy("token", "band").agg(
        F.slice(F.sort_array(F.collect_list("id")), 1, PIVOTS).alias("least"))  # of CELLS ids at most
    pivots = (
        bands.union(bands.select("token", F.col("band") + 1, "least"))
        .groupBy("token", "band").agg(F.flatten(F.collect_list("least")).alias("pivots"))
    )
    copied = cells.drop("id").hint("merge").join(pivots, ["token", "band"])
    met = materialize(rows.hint("merge").join(copied, ["token", "band", "cell"]).select("key", "id", "n", "pivots"), "ngram-met", files)
    discard(rows, cells)
    pairs = met.select("id", F.explode("pivots").alias("pivot")).where("id <> pivot").select(
        F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    return pairs, met.select("key", "id", F.col("n").cast("long").alias("n"))


def _classes(rows: DataFrame, files: int) -> DataFrame:
    """(id = class digest, n, bitmap, row = smallest row id) of the classes with shingles, written once."""
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id"))
    found = rows.where("n > 0").groupBy(F.col("digest").alias("class")).agg(
        F.max("n").alias("n"), F.max("bitmap").alias("bitmap"), least.alias("m"))
    found = found.select(F.col("class").alias("id"), "n", "bitmap", F.col("m.id").alias("row"))
    return materialize(found.coalesce(files), "ngram-classes")


def _shingle_arrays(source: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, shingles) of the classes ``wanted`` (id), from one more pass over the texts: a bitmap of fixed
    size of their row ids says which texts to cut; no text is shuffled."""
    spark = source.sparkSession
    place = F.xxhash64("row").bitwiseAND(F.lit((1 << REPEATED_BITS) - 1))
    named = classes.join(wanted.hint("merge"), "id", "left_semi").select(place.alias("place"))
    words = named.groupBy(F.shiftright("place", 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (REPEATED_BITS - 6), np.uint64)
    bitmap[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(bitmap)

    def run(batches):
        sent = set()
        for batch in batches:
            at = batch.column(0).to_numpy()
            picked = np.flatnonzero((shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1))
            ids, values = [], []
            for found in _sets(batch.column(1).take(pa.array(picked))):
                digest = _set_digest(found)
                if len(found) and digest not in sent:
                    sent.add(digest)
                    ids.append(digest), values.append(as_long(found))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.list_(pa.int64()))], ["id", "shingles"])

    places = source.select(F.xxhash64("id").bitwiseAND(F.lit((1 << REPEATED_BITS) - 1)).alias("place"), "text")
    arrays = places.mapInArrow(run, "id long, shingles array<long>")
    return arrays.join(wanted.hint("merge"), "id", "left_semi").groupBy("id").agg(F.first("shingles").alias("shingles"))


def _bounds(both: np.ndarray, bits_here, bits_there, size_here, size_there) -> np.ndarray:
    """Upper bounds of the overlap from the bits that both bitmaps have: a bit set on one side only
    stands for a shingle missing on the other."""
    return np.minimum(size_here - (bits_here - both), size_there - (bits_there - both))


def _folded(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) of a smaller width."""
    return np.bitwise_or.reduce(bitmaps.reshape(len(bitmaps), -1, words), axis=1)


def _allowed(pairs: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs whose sizes and bitmaps allow the threshold (needs na, va, nb, vb: sizes, bitmaps)."""
    up, down = threshold.numerator, threshold.denominator

    def run(batches):
        for batch in batches:
            na, nb = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("na", "nb"))
            bound = np.zeros(len(na), np.int64)
            for i, (x, y) in enumerate(zip(batch.column("va"), batch.column("vb"))):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64)[None] for v in (x, y))
                words = min(x.size, y.size)
                x, y = _folded(x, words), _folded(y, words)
                both, here, there = (int(np.bitwise_count(v).sum()) for v in (x & y, x, y))
                bound[i] = _bounds(both, here, there, na[i], nb[i])
            yield batch.filter(pa.array(bound * (up + down) >= up * (na + nb))).select(["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, source: DataFrame, classes: DataFrame, threshold: Fraction, files: int) -> DataFrame:
    """The pairs (a, b; a below b, each once) whose exact similarity reaches the threshold, written."""
    up, down = threshold.numerator, threshold.denominator

    def side(table, end, value):
        names = {"id": end, "n": f"n{end}", value: f"v{end}"}
        return table.select(*[F.col(c).alias(names[c]) for c in table.columns if c in names])

    sized = (
        pairs.hint("merge").join(side(classes, "a", "bitmap"), "a").hint("merge").join(side(classes, "b", "bitmap"), "b")
        .where(F.least("na", "nb") * down >= F.greatest("na", "nb") * up)
    )
    survivors = keep(_allowed(sized, threshold))
    if survivors.isEmpty():
        discard(survivors)
        return source.sparkSession.createDataFrame([], "a long, b long")
    wanted = survivors.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    arrays = keep(_shingle_arrays(source, classes, wanted))
    shared, both = F.size(F.array_intersect("va", "vb")), F.size("va") + F.size("vb")
    links = materialize(
        survivors.hint("merge").join(side(arrays, "a", "shingles"), "a").hint("merge")
        .join(side(arrays, "b", "shingles"), "b")
        .where(shared * down >= (both - shared) * up)
        .select("a", "b"), "ngram-links", files)
    discard(survivors, arrays)
    return links


def _forest(a: np.ndarray, b: np.ndarray, margin: np.ndarray, vertices: int) -> np.ndarray:
    """Numbers of the edges (a, b) of a spanning forest of largest margins, by Boruvka's rounds."""
    order = np.argsort(margin, kind="stable")  # later edges win, equal margins by their place
    label, chosen = np.arange(vertices), []
    while len(order):
        x, y = label[a[order]], label[b[order]]
        apart = x != y
        order, x, y = order[apart], x[apart], y[apart]
        best = np.full(vertices, -1)
        best[x] = np.arange(len(x))
        np.maximum.at(best, y, np.arange(len(y)))
        picked = np.unique(best[best >= 0])
        chosen.append(order[picked])
        for u, v in zip(x[picked], y[picked]):  # at most one edge a component
            while label[u] != u:
                u = label[u]
            while label[v] != v:
                v = label[v]
            label[max(u, v)] = min(u, v)
        while (label[label] != label).any():
            label = label[label]
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def _tile_pairs(ids, comps, sizes, sides, bitmaps: list, threshold: float):
    """Batches of (i, j, margin): pairs of a tile's rows from different components, one of either
    block (``sides``: bits 1 and 2), whose sizes and bitmaps allow the threshold, each pair once."""
    share = threshold / (1 + threshold)
    width = np.array([len(m) // 8 for m in bitmaps])
    for words in np.unique(width):
        here = np.flatnonzero(width == words)
        flat = np.frombuffer(b"".join(bitmaps[i] for i in here), np.uint64).reshape(len(here), -1)
        bits = np.bitwise_count(flat).sum(axis=1, dtype=np.int64)
        for wide in np.unique(width[width >= words]):
            there, other, other_bits = here, flat, bits
            if wide > words:
                there = np.flatnonzero(width == wide)
                if threshold * sizes[there].min() > sizes[here].max():
                    continue
                other = _folded(np.frombuffer(b"".join(bitmaps[i] for i in there), np.uint64).reshape(len(there), -1), words)
                other_bits = np.bitwise_count(other).sum(axis=1, dtype=np.int64)
            step = max(1, (1 << 22) // max(1, len(there) * int(words)))
            for at in range(0, len(here), step):
                own = slice(at, at + step)
                i, j = here[own, None], there[None]
                ok = (comps[i] != comps[j]) & ((sides[i] | sides[j]) == 3)
                ok &= np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-6
                if wide == words:
                    ok &= i < j
                x, y = np.nonzero(ok)
                x += at
                for k in range(0, len(x), max(1, (1 << 21) // int(words))):
                    u, v = x[k: k + (1 << 21) // int(words)], y[k: k + (1 << 21) // int(words)]
                    both = np.bitwise_count(flat[u] & other[v]).sum(axis=1, dtype=np.int64)
                    n, m = sizes[here[u]], sizes[there[v]]
                    margin = _bounds(both, bits[u], other_bits[v], n, m) - share * (n + m)
                    passed = margin >= -1e-6
                    if passed.any():
                        yield here[u[passed]], there[v[passed]], margin[passed]


def _passing(tiles: DataFrame, threshold: Fraction, forest: bool) -> DataFrame:
    """Pairs (kind 0: a, b) from two blocks whose sizes and bitmaps allow the threshold: all, or a
    spanning forest of them, and then a row (kind 1: key) for tiles of which pairs were left out."""
    ratio = float(threshold)

    def compare(key, frame):
        names, x, y = (k.as_py() for k in key)
        ids, comps, sizes, block = (frame.column(c).to_numpy() for c in ("id", "component", "n", "block"))
        sides = np.where(block == x, 1, 0) | np.where(block == y, 2, 0)
        vertex = np.unique(comps, return_inverse=True)[1]
        kept, total = [], 0
        for i, j, margin in _tile_pairs(ids, comps, sizes, sides, frame.column("bitmap").to_pylist(), ratio):
            total += len(i)
            kept.append((i, j, margin))
            if forest and sum(len(k[0]) for k in kept) > 4 * len(ids):
                kept = [_thinned(kept, vertex)]
        if forest and kept:
            kept = [_thinned(kept, vertex)]
        i, j = (np.concatenate([k[c] for k in kept]) if kept else np.zeros(0, np.int64) for c in (0, 1))
        a, b = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
        more = 1 if forest and total > len(i) else 0
        return pa.table({
            "kind": pa.array(np.append(np.zeros(len(a), np.int32), np.ones(more, np.int32))),
            "key": pa.array(np.full(len(a) + more, names, np.int64)),
            "a": pa.array(np.append(a, np.zeros(more, np.int64))), "b": pa.array(np.append(b, np.zeros(more, np.int64)))})

    def _thinned(kept, vertex):
        i, j, margin = (np.concatenate(c) for c in zip(*kept))
        edges = _forest(vertex[i], vertex[j], margin, int(vertex.max()) + 1)
        return i[edges], j[edges], margin[edges]

    return tiles.groupBy("key", "x", "y").applyInArrow(compare, "kind int, key long, a long, b long")


def _open(members: DataFrame, labels: DataFrame, classes: DataFrame, files: int) -> DataFrame:
    """``members`` (key, id, n) of groups with more than one component, with component, bitmap and the
    number of blocks of their group, written."""
    labelled = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    keys = (
        labelled.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
        .where("lo <> hi").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    )
    found = labelled.join(keys, "key").join(classes.select("id", "bitmap"), "id")
    found = found.select("key", "id", "n", "component", "blocks", "bitmap")
    return materialize(found.coalesce(files), "ngram-open")  # in the join's order, so that equal bitmaps are stored once


def _blocked(members: DataFrame) -> DataFrame:
    """Members of open groups, dealt to tiles of two blocks of about BLOCK rows."""
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return members.select(
        "key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        "id", "n", "component", "block", "bitmap")


def ngram_jaccard_join(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id.

    ``component_id`` is the smallest id reachable over links of similarity >= threshold, the
    row's own id included. Words are lower-cased in A-Z only. Texts of one to four words have one
    shingle, their whole sequence; null or wordless texts have none and are linked with nothing
    (component_id is their own id). Ids may repeat or be null: null ids count as larger than any
    other, and rows are kept one for one. An empty table gives an empty table; other columns,
    whatever their names, are not read.
    """
    rows, labels = _linked(docs, id_column, text_column, threshold)
    grouped = (
        rows.groupBy("digest").agg(F.min("id").alias("least"))
        .join(labels.withColumnRenamed("id", "digest"), "digest", "left")
        .withColumn("component", F.coalesce("component", "digest"))
    )
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "component").select("digest", "component_id")
    return rows.join(named, "digest", "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _linked(docs: DataFrame, id_column: str, text_column: str, threshold: Fraction) -> tuple[DataFrame, DataFrame]:
    """(rows (id, n, digest) of ``docs``, labels (id = digest, component) of the classes with links)."""
    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    prefix = _prefix_rows(source, threshold, *_order(source, threshold))
    dealt = prefix.repartition(F.when(F.col("kind") == 1, F.col("token")).otherwise(F.xxhash64("token", "id")))
    tiles = materialize(_tiles(dealt.sortWithinPartitions("kind", "token", "id"), threshold), "ngram-tiles")
    rows = tiles.where("kind = 2").select(
        F.col("key").alias("id"), F.col("b").alias("n"), F.col("a").alias("digest"), "bitmap")
    bitmaps, rows = rows, materialize(rows.drop("bitmap"), "ngram-rows")
    files = max(LEAST_FILES, -(-rows.count() // ROWS_A_FILE))
    pairs = tiles.where("kind = 0").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    members = tiles.where("kind = 1").select("key", F.col("a").alias("id"), F.col("b").alias("n")).distinct()
    large = tiles.where("kind = 3").select(F.col("key").alias("token"), F.col("a").alias("id"), F.col("b").alias("n"))
    if not large.isEmpty():
        more_pairs, more_members = _large_groups(large, threshold, files)
        pairs, members = pairs.union(more_pairs).distinct(), members.union(more_members)
    classes = _classes(bitmaps, files)
    links = _verified(pairs, source, classes, threshold, files)
    labels = connected_components(links)
    is_open = _open(members, labels, classes, files)
    discard(tiles)
    if not is_open.isEmpty():
        found = materialize(_passing(_blocked(is_open), threshold, forest=True), "ngram-forest", files)
        tried = found.where("kind = 0").select("a", "b").distinct()
        links = _verified(tried, source, classes, threshold, files)
        if not links.isEmpty():
            labels = materialize(join_components(labels, links), "ngram-labels", files)
        more = found.where("kind = 1").select("key").distinct()
        if not more.isEmpty():
            left = is_open.join(more, "key", "left_semi")
            still = _open(left.select("key", "id", "n"), labels, classes, files)
            rest = _passing(_blocked(still), threshold, forest=False).select("a", "b").distinct()
            links = _verified(rest.join(tried, ["a", "b"], "left_anti"), source, classes, threshold, files)
            if not links.isEmpty():
                labels = join_components(labels, links)
            discard(still)
        discard(found)
    discard(is_open, classes)
    return rows, labels
