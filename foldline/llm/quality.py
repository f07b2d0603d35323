"""Document quality by distribution divergence, in DataFrame functions only.

Each document's character-class histogram and common-word histogram are compared with those of
its language by the Jensen-Shannon distance. The references are the pooled counts of all documents
of the language that have at least 50 words. A histogram is compared only if the document is long
enough for it (``MIN_CHARS``, ``MIN_COMMON``). The plain counts of repetition and length decide first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
MIN_WORDS = 50
MIN_CHARS = 200
MIN_COMMON = 100
MAX_CHAR_DISTANCE = 0.26
MAX_WORD_DISTANCE = 0.23

# Frequent function words by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "was", "for", "on", "are", "with"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "ist"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"],
}
BINS = 12

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# name and pattern of each counted class; white space and letters are what remains
CLASSES = [("upper", "[A-Z]+"), ("digit", "[0-9]+"), ("symbol", r"[#*$%&|<>]+"),
           ("mark", r"[\x21\x22\x27-\x29\x2B-\x2F:;=?@\x5B-\x60{}~]+")]
PLAIN = r"[a-z\x20\x09-\x0D]+"  # in no counted class; dropped once, before the classes are counted


def _language(column: str) -> Column:
    """The row's language if it has a word list, else '' (one reference for all others)."""
    return F.when(F.col(column).isin(list(COMMON_WORDS)), F.col(column)).otherwise(F.lit(""))


def _histograms(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """``docs`` as a struct column `_row`, with `_text`, `_words`, `_lang`, `_chars`, `_common`."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("_text"),
        _language(f"`{lang_column}`").alias("_lang"),
    ).withColumn("_trimmed", F.btrim("_text", F.lit(SPACE)))
    rows = rows.withColumn("_words", F.when(
        F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("_trimmed", SPACE_RUN)))
    rows = rows.withColumn("_size", F.length("_text")).withColumn(
        "_word_chars", F.length(F.array_join("_words", "")))
    rows = rows.withColumn("_rest", F.regexp_replace("_text", PLAIN, ""))
    counted = [F.length("_rest") - F.length(F.regexp_replace("_rest", p, "")) for _, p in CLASSES]
    rows = rows.withColumn("_classes", F.array(*counted, F.col("_size") - F.col("_word_chars")))
    letters = F.col("_size") - F.aggregate("_classes", F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("_chars", F.concat("_classes", F.array(letters)))
    lists = F.lit(None).cast("array<string>")
    for lang, words in COMMON_WORDS.items():
        lists = F.when(F.col("_lang") == lang, F.array(*map(F.lit, words))).otherwise(lists)
    rows = rows.withColumn("_list", lists)
    counts, left = [], F.size("_words")
    for i in range(BINS):
        found = F.size("_words") - F.size(F.array_remove("_words", F.get("_list", F.lit(i))))
        counts.append(found)
        left = left - found
    rows = rows.withColumn("_bins", F.when(F.col("_list").isNotNull(), F.array(*counts)))
    other = F.size("_words") - F.aggregate("_bins", F.lit(0), lambda a, b: a + b)
    return rows.withColumn("_common", F.concat("_bins", F.array(other)))


def references(rows: DataFrame) -> dict[str, tuple]:
    """Pooled histograms (`_chars`, `_common`) by `_lang`: one for each word list, one for the rest."""
    sums = [F.sum(F.get("_chars", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES) + 2)]
    sums += [F.sum(F.get("_common", F.lit(i))).alias(f"w{i}") for i in range(BINS + 1)]
    found = {}
    for row in rows.where(F.col("_n") >= MIN_WORDS).groupBy("_lang").agg(*sums).collect():
        chars = [row[f"c{i}"] for i in range(len(CLASSES) + 2)]
        common = [row[f"w{i}"] for i in range(BINS + 1) if row[f"w{i}"] is not None]
        found[row["_lang"]] = (chars, common)
    return found


def _shares(counts: list[int]) -> list[float]:
    total = sum(counts)
    return [c / total for c in counts] if total else [0.0] * len(counts)


def _distance(counts: str, reference: str) -> Column:
    """Jensen-Shannon distance (base 2) of a histogram and a reference of as many shares."""
    total = F.aggregate(counts, F.lit(0), lambda a, b: a + b)

    def term(share, middle):
        return F.when(share > 0, share * F.log2(share / middle)).otherwise(F.lit(0.0))

    def pair(count, expected):
        share = count / total
        middle = (share + expected) / 2
        return term(share, middle) + term(expected, middle)

    divergence = F.aggregate(F.zip_with(counts, reference, pair), F.lit(0.0), lambda a, b: a + b) / 2
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def _repeat_words(rows: DataFrame) -> DataFrame:
    """`_repeats`: words covered by a 3-word window that occurs twice or more in the text.

    Windows are compared by a 64-bit hash within one text. Only texts with a repeated window sort
    their windows; the repeated positions, in order, then cover up to three words each."""
    n = F.size("_words")
    empty = F.array().cast("array<bigint>")
    rows = rows.withColumn("_grams", F.when(n >= 3, F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
    )).otherwise(empty))
    rows = rows.withColumn("_ranked", F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.sort_array(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    ))
    def same(x, j):
        return x["g"] == F.get("_ranked", j)["g"]

    rows = rows.withColumn("_places", F.sort_array(F.transform(
        F.filter("_ranked", lambda x, j: F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False))),
        lambda x: x["i"],
    )))
    covered = F.transform("_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1), p + 3) - p))
    return rows.withColumn("_repeats", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)))


def _measured(docs: DataFrame, text_column: str, lang_column: str) -> DataFrame:
    """`_row`, the counts, `_size`, `_lang` and the two histograms of every row."""
    rows = _repeat_words(_histograms(docs, text_column, lang_column))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)))
    found = F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.col("_word_chars").cast("long").alias("word_chars"),
        F.get("_classes", F.lit(2)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeats").cast("long").alias("n_repeat_words"),
        "_size", "_lang", "_chars", "_common", F.size("_words").alias("_n"),
    )
    # a one-row generator: filters on the measures are not copied below it and computed twice
    return rows.select("_row", F.inline(F.array(found)))


def _judged(rows: DataFrame, known: dict[str, tuple]) -> DataFrame:
    """`base_failed`, `char_distance`, `word_distance` and `kept` added to measured rows."""
    char_ref = F.lit(None).cast("array<double>")
    word_ref = F.lit(None).cast("array<double>")
    for lang, (chars, common) in sorted(known.items()):
        mine = F.col("_lang") == lang
        char_ref = F.when(mine, F.array(*map(F.lit, _shares(chars)))).otherwise(char_ref)
        if lang and sum(common):
            word_ref = F.when(mine, F.array(*map(F.lit, _shares(common)))).otherwise(word_ref)
    rows = rows.withColumn("_char_ref", char_ref).withColumn("_word_ref", word_ref)
    short = F.col("n_words") < MIN_WORDS
    rows = (
        rows.withColumn("base_failed", short | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .withColumn("char_distance", F.when(F.col("_size") >= MIN_CHARS, _distance("_chars", "_char_ref")))
        .withColumn("word_distance", F.when(F.col("n_words") >= MIN_COMMON, _distance("_common", "_word_ref")))
    )
    fits = (F.coalesce("char_distance", F.lit(0.0)) <= MAX_CHAR_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE)
    return rows.withColumn("kept", ~F.col("base_failed") & fits)


def quality_report(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """One row per row of ``docs``: its columns but the text, the counts, `base_failed`,
    `char_distance`, `word_distance` and `kept`.

    A null or empty text has no words and fails the length rule. A language without a word list,
    or null, is compared by character classes only, with the pooled other languages. Distances are
    null where the document is too short for them, or no reference exists. Columns of ``docs`` that
    bear one of these names are replaced; all others stay. Rows are judged one by one, so repeated
    rows get equal results; an empty table gives an empty result. The texts are read once: measures
    are written to the shared folder, pooled, then judged.
    """
    added = [*COUNTS, "base_failed", "char_distance", "word_distance", "kept"]
    names = [c for c in docs.columns if c not in (*added, text_column)]
    rows = _measured(docs, text_column, lang_column)
    rows = rows.withColumn("_row", F.struct(*[F.col("_row")[c].alias(c) for c in names], F.lit(0).alias("_")))
    rows = materialize(rows, "quality")
    rows = _judged(rows, references(rows))
    return rows.select(*[F.col("_row")[c].alias(c) for c in names], *added)


def quality_filter(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``quality_report`` keeps, with their columns. Texts are read twice
    (references, then verdicts), which spares writing them."""
    light = _histograms(docs, text_column, lang_column).withColumn("_n", F.size("_words"))
    rows = _judged(_measured(docs, text_column, lang_column), references(light))
    return rows.where("kept").select("_row.*")
