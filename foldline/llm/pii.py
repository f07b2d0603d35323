"""Personal data by weak supervision, in DataFrame functions only.

Base spans (exact patterns and checks) always stay. Wider patterns propose further candidates:
spelled-out e-mail addresses, long-form IP addresses, card numbers with other separators, phone
numbers without a plus sign. Labelers vote on every span, base and proposed: regular expressions
(format), gazetteers (top-level domains, card prefixes, calling codes) and context (words before,
characters around). Expectation maximisation over the table of vote patterns estimates, per kind, how
reliable each labeler is, without labels. A logistic span classifier is then trained on the resulting
posteriors; proposed spans that it accepts are added.

Only the table of vote patterns reaches the driver: at most 4 kinds * 3 ** labelers * 2 rows,
whatever the data. Positions come from regular-expression pieces: the gaps between the matches and
the matches, summed up in blocks, so the work is linear in the text (times a block for many spans).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ["email", "ip", "card", "phone"]
BLOCK = 128
EM_ROUNDS = 30
TRAIN_ROUNDS = 200
ACCEPT = 0.9

# name: (kind, pattern, cheap gate). Matches of the base patterns start where the previous match
# ended (\G) or at the start of a run of their first character class; runs are taken possessively.
_RUN = r"(?:\G|(?<![A-Za-z0-9._%+-]))"
BASE = {
    "email": ("email", _RUN + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": ("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])", r"[0-9](?:[\x20-]?[0-9]){11}"),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
WIDE = {
    "spelled": ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z0-9-]++)++", r"[\[(](?:at|AT)[\])]"),
    "long_ip": ("ip", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"),
    "grouped": ("card", r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])", r"[0-9]{4}[./_][0-9]{4}"),
    "local": ("phone", r"(?<![0-9+().-])(?<![0-9)]\x20)\(?[0-9]{2,4}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])", r"[0-9]{3}[\x20.-][0-9]{4}"),
}

# Gazetteers and context words.
DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|ch|at|it|nl"
CALLING = r"^\D*(?:1|7|20|27|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CONTEXT = {
    "email": r"(?i)e-?mail|contact|write|mailto|kontakt|correo|courriel",
    "ip": r"(?i)\bip\b|host|server|address|login|adresse|direcci",
    "card": r"(?i)card|visa|credit|payment|karte|carte|tarjeta",
    "phone": r"(?i)phone|\btel|call|fax|mobil|telefon|téléphone",
}


def _spans(rows: DataFrame, name: str, pattern: str, gate: str) -> DataFrame:
    """Adds `name`: array of (start, end, match, before, after) of the pattern's matches."""
    found = F.when(F.col("_text").rlike(gate), F.regexp_extract_all("_text", F.lit(pattern), 0))
    rows = rows.withColumn("_m", F.coalesce(found, F.array().cast("array<string>")))
    some = F.size("_m") > 0
    rows = rows.withColumn("_p", F.when(some, F.split("_text", pattern, -1)))
    lengths = F.zip_with(F.slice("_p", F.lit(1), F.size("_m")), "_m", lambda p, m: F.length(p) + F.length(m))
    rows = rows.withColumn("_l", F.when(some, lengths))

    def add(values):
        return F.aggregate(values, F.lit(0), lambda a, b: a + b)

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_l") - 1) / BLOCK).cast("int")),
        lambda b: add(F.slice("_l", b * BLOCK + 1, F.lit(BLOCK))))
    rows = rows.withColumn("_b", F.when(some, blocks))
    sums = F.transform("_b", lambda x, b: add(F.slice("_b", F.lit(1), b)))
    rows = rows.withColumn("_s", F.when(some, sums))

    def span(m, i):
        block = F.floor(i / BLOCK).cast("int")
        before = F.get("_s", block) + add(F.slice("_l", block * BLOCK + 1, F.pmod(i, F.lit(BLOCK))))
        gap = F.get("_p", i)
        start = before + F.length(gap)
        return F.struct(
            start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match"),
            F.right(gap, F.lit(40)).alias("before"), F.left(F.get("_p", i + 1), F.lit(1)).alias("after"))

    empty = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")
    rows = rows.withColumn(name, F.when(some, F.transform("_m", span)).otherwise(empty))
    return rows.drop("_m", "_p", "_l", "_b", "_s")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    """The base check of a match."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _votes(kind: str, base: bool, span: Column) -> list[Column]:
    """Votes of the labelers for a span: + for personal data, - against, 0 abstains."""
    match, digits = span["match"], _digits(span["match"])

    def vote(yes, no=None):
        out = F.when(yes, F.lit("+"))
        return (out.when(no, F.lit("-")) if no is not None else out).otherwise(F.lit("0"))

    form = F.lit("+") if base else F.lit("0")
    if kind == "email":
        check = vote(match.rlike(r"[A-Za-z].*[@)\]]"), F.length(match) < 8)
        listed = vote(match.rlike(rf"(?:\.|[)\]]\x20?)(?:{DOMAINS})$"), match.rlike(r"[0-9]$"))
    elif kind == "ip":
        check = vote(match.rlike(r"^(?!0)(?!.*\.0[0-9])"), match.rlike(r"^0\."))
        listed = vote(match.rlike(r"^(?:10\.|127\.|192\.168\.)") | match.rlike("::|:.*:"), match.rlike(r"^[0-9]\.[0-9]\.[0-9]\.[0-9]$"))
    elif kind == "card":
        check = vote(F.call_function("luhn_check", digits), ~F.call_function("luhn_check", digits))
        listed = vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), digits.rlike("^0"))
    else:
        check = vote(F.length(digits).between(9, 15), F.length(digits) < 7)
        listed = vote(match.rlike(CALLING), match.rlike(r"^\D*0000"))
    context = vote(span["before"].rlike(CONTEXT[kind]))
    edges = vote(
        ~span["before"].rlike("[A-Za-z0-9]$") & ~F.coalesce(span["after"], F.lit("")).rlike("[A-Za-z0-9]"),
        span["before"].rlike("[A-Za-z0-9]$"))
    grouped = vote(match.rlike(r"[\x20().-]") if kind in ("card", "phone") else F.lit(True))
    return [form, check, listed, context, edges, grouped]


LABELERS = 6


def _candidates(docs: DataFrame, text_column: str) -> DataFrame:
    """`_row` (the other columns), `base` and `wide`: arrays of (start, kind, end, code)."""
    names = [c for c in docs.columns if c != text_column]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names], F.lit(0).alias("_")).alias("_row"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("_text"))
    def coded(column, kind, base):
        found = F.filter(column, lambda s: _valid(kind, s["match"])) if base else F.col(column)
        return F.transform(found, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end"),
            F.concat(F.lit(f"{kind}:"), *_votes(kind, base, s)).alias("code")))

    arrays = {"base": [], "wide": []}
    for group, patterns in (("base", BASE), ("wide", WIDE)):
        for name, (kind, pattern, gate) in patterns.items():
            rows = _spans(rows, f"_{group}_{name}", pattern, gate)
            arrays[group].append(coded(f"_{group}_{name}", kind, group == "base"))
    return rows.select(
        "_row", F.array_sort(F.concat(*arrays["base"])).alias("base"), F.array_sort(F.concat(*arrays["wide"])).alias("wide"))


_VALUE = {"+": 1.0, "-": -1.0, "0": 0.0}


def estimate_reliabilities(counts: dict[str, int]) -> dict[str, float]:
    """Posterior that a span is personal data, for each vote pattern ``kind:votes``, by EM per kind.

    The model has a prior and, for each labeler, the chances of its three votes given the truth
    (starting as better than chance); it is the maximum-likelihood fit of the pattern counts with
    one pseudo-count a vote."""
    posterior = {}
    for kind in KINDS:
        table = {c: n for c, n in counts.items() if c.startswith(f"{kind}:")}
        if not table:
            continue
        votes = {c: c.partition(":")[2] for c in table}
        prior = 0.5
        chance = [{"+": (0.6, 0.2), "0": (0.3, 0.4), "-": (0.1, 0.4)} for _ in range(LABELERS)]
        for _ in range(EM_ROUNDS):
            for code in table:
                yes, no = math.log(prior), math.log(1 - prior)
                for i, v in enumerate(votes[code]):
                    yes += math.log(chance[i][v][0])
                    no += math.log(chance[i][v][1])
                posterior[code] = 1 / (1 + math.exp(min(700.0, max(-700.0, no - yes))))
            total = sum(table.values())
            positive = sum(n * posterior[c] for c, n in table.items())
            prior = (positive + 1) / (total + 2)
            for i in range(LABELERS):
                for v in "+0-":
                    yes = sum(n * posterior[c] for c, n in table.items() if votes[c][i] == v)
                    no = sum(n * (1 - posterior[c]) for c, n in table.items() if votes[c][i] == v)
                    chance[i][v] = ((yes + 1) / (positive + 3), (no + 1) / (total - positive + 3))
    return posterior


def train_classifier(counts: dict[str, int], posterior: dict[str, float]) -> dict[str, float]:
    """Scores of a logistic classifier of votes, fitted to the posteriors of all spans: one weight
    for each vote of each labeler, shared by the kinds, and one for each kind."""
    def features(code):
        kind, _, votes = code.partition(":")
        return [f"kind {kind}", *(f"{i}{v}" for i, v in enumerate(votes) if v != "0")]

    weight: dict[str, float] = {}
    total = sum(counts.values())

    def score(code):
        z = sum(weight.get(f, 0.0) for f in features(code))
        return 1 / (1 + math.exp(min(700.0, max(-700.0, -z))))

    for _ in range(TRAIN_ROUNDS if total else 0):
        step: dict[str, float] = {}
        for code, n in counts.items():
            miss = n / total * (posterior[code] - score(code))
            for f in features(code):
                step[f] = step.get(f, 0.0) + miss
        for f, g in step.items():
            weight[f] = weight.get(f, 0.0) * 0.999 + 2.0 * g
    return {code: score(code) for code in counts}


def pii_spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its columns but the text, `base` and `spans`: arrays of (start,
    kind, end, code), by start, then kind (place in KINDS); code points, end exclusive.

    Null and empty texts give empty arrays; repeated rows give equal results; an empty table gives
    an empty result; columns named base or spans are replaced. Texts are read once: the candidates
    are written to the shared folder, their vote patterns counted over all rows, then judged."""
    rows = materialize(_candidates(docs, text_column), "pii")
    codes = rows.select(F.explode(F.concat("base", "wide")).alias("s")).groupBy("s.code").count()
    counts = {r["code"]: r["count"] for r in codes.collect()}  # bounded by the labelers' patterns
    scores = train_classifier(counts, estimate_reliabilities(counts))
    accepted = sorted(c for c, s in scores.items() if s >= ACCEPT)
    names = [c for c in docs.columns if c not in (text_column, "base", "spans")]
    if accepted:
        free = F.filter("wide", lambda w: w["code"].isin(accepted) & ~F.exists(
            "base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    else:
        free = F.filter("wide", lambda w: F.lit(False))
    rows = rows.withColumn("spans", F.array_sort(F.concat("base", free)))
    return rows.select(*[F.col("_row")[c].alias(c) for c in names], "base", "spans")


def span_text(spans: str) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, counts of base spans by kind, sha256 of the base spans, all spans as text."""
    rows = pii_spans(docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text")))
    def of_kind(i):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")

    counts = [of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return rows.select(F.col("doc_id").alias(id_column), *counts, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans"))
