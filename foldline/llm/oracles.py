"""DuckDB SQL for the queries that SQL can express, over the same tables."""

_WORDS = """regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+')"""

# distinct shingles: every run of five words, or the whole sequence of one to four
_SHINGLES = """SELECT DISTINCT {keys}, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM {source}"""

_TERM = "(CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0.0 END)"


def _distance(counts: str, reference: str) -> str:
    """Jensen-Shannon distance of a list of counts and a list of pooled counts."""
    p, q = f"({counts}[i] / list_sum({counts}))", f"({reference}[i] / list_sum({reference}))"
    terms = _TERM.format(x=p, p=p, q=q) + " + " + _TERM.format(x=q, p=p, q=q)
    return f"sqrt(greatest(list_sum(list_transform(range(1, len({counts}) + 1), lambda i: {terms})) / 2, 0))"


def _quality_sql() -> str:
    from .quality import CLASSES, COMMON_WORDS, MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE, MIN_CHARS, MIN_COMMON, MIN_WORDS

    lists = " ".join(f"WHEN l = '{lang}' THEN {words!r}" for lang, words in COMMON_WORDS.items())
    langs = ", ".join(f"'{lang}'" for lang in COMMON_WORDS)
    classes = ", ".join(f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))" for _, pattern in CLASSES)
    pooled = ", ".join(f"[{', '.join(f'sum({name}[{i + 1}])' for i in range(size))}] AS {name}"
                       for name, size in (("chars", len(CLASSES) + 2), ("common", len(next(iter(COMMON_WORDS.values()))) + 1)))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
  CASE WHEN lang IN ({langs}) THEN lang ELSE '' END AS l FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, CASE {lists} END AS list,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
c AS (SELECT *, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, [{classes}] AS cls,
  list_transform(list, lambda x: len(list_filter(words, lambda y: y = x))) AS bins FROM w),
h AS (SELECT *, list_concat(cls, [length(t) - word_chars, word_chars - list_sum(cls)]) AS chars,
  list_concat(bins, [n_words - list_sum(bins)]) AS common FROM c),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS s
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w))),
rep AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS at FROM g, range(3) x(k) WHERE n > 1) GROUP BY r),
ref AS (SELECT l, {pooled} FROM h WHERE n_words >= {MIN_WORDS} GROUP BY l),
j AS (SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(cls[3] AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, length(t) AS size, h.chars, h.common, ref.chars AS ref_chars,
  CASE WHEN h.l <> '' AND list_sum(ref.common) > 0 THEN ref.common END AS ref_common
  FROM h LEFT JOIN rep USING (r) LEFT JOIN ref ON ref.l = h.l),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  CASE WHEN size >= {MIN_CHARS} AND ref_chars IS NOT NULL THEN {_distance("chars", "ref_chars")} ELSE 0 END AS cd,
  CASE WHEN n_words >= {MIN_COMMON} AND ref_common IS NOT NULL THEN {_distance("common", "ref_common")} ELSE 0 END AS wd FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND cd <= {MAX_CHAR_DISTANCE} AND wd <= {MAX_WORD_DISTANCE} AS kept FROM v"""


ORACLE_SQL = {
    "op8_quality_rules": _quality_sql(),
    "op1_mix": """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(concat_ws(':', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank, CAST(sum(source_size) OVER () AS BIGINT) AS total,
  3 * source_size AS cap FROM s),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM r),
l AS (SELECT *, row_number() OVER o AS place,
  CAST(total - coalesce(CAST(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS DOUBLE)
  / CAST(sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, rank)),
t AS (SELECT *, CASE WHEN cap < weight * level OR NOT EXISTS (SELECT 1 FROM l WHERE cap >= weight * level) THEN CAST(cap AS DOUBLE)
  ELSE weight * (SELECT arg_min(level, place) FROM l WHERE cap >= weight * level) END AS target FROM l),
q AS (SELECT d.*, t.source_size, t.target, t.rank, t.total,
  CAST(sum(size) OVER (PARTITION BY t.rank ORDER BY h) AS BIGINT) AS sent
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, (g.i * source_size + sent) / target AS finish FROM q, range(3) g(i) WHERE target > 0),
c AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, h) AS upto FROM e),
k AS (SELECT rank, h, count(DISTINCT i) FILTER (WHERE upto <= total) AS n FROM c GROUP BY rank, h)
SELECT doc_id, size, source_size, target, CAST(size * coalesce(k.n, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k ON k.rank = q.rank AND k.h = q.h""",
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM r)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f""",
    "op6_decontaminate": f"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="text")} AS w FROM documents),
iw AS (SELECT row_number() OVER () AS k, item_id, {_WORDS.format(text="text")} AS w FROM benchmark),
ds AS ({_SHINGLES.format(keys="r, doc_id", source="dw")}),
items AS ({_SHINGLES.format(keys="k, item_id", source="iw")}),
size AS (SELECT k, count(*) AS n FROM items GROUP BY k),
hit AS (SELECT r, doc_id, k, item_id, count(*) AS f FROM ds JOIN items USING (s) GROUP BY r, doc_id, k, item_id)
SELECT doc_id, item_id, n AS item_shingles, f AS found_shingles
FROM hit JOIN size USING (k) WHERE 100 * f >= 75 * n""",
    "op9_ngram_jaccard_join": f"""
WITH RECURSIVE dw AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text="text")} AS w FROM documents),
ds AS MATERIALIZED ({_SHINGLES.format(keys="r, doc_id", source="dw")}),
size AS MATERIALIZED (SELECT r, count(*) AS n FROM ds GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS f FROM ds a JOIN ds b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r),
link AS MATERIALIZED (SELECT x, y FROM shared JOIN size p ON p.r = x JOIN size q ON q.r = y
  WHERE 100 * f >= 75 * (p.n + q.n - f)),
edge AS MATERIALIZED (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT r AS x, r AS y FROM dw UNION SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, c.component_id
FROM dw d LEFT JOIN size USING (r)
JOIN (SELECT x AS r, min(dw.doc_id) AS component_id FROM reach JOIN dw ON dw.r = reach.y GROUP BY x) c USING (r)""",
    "op13_spelling_variants": """
WITH RECURSIVE t AS MATERIALIZED (SELECT list_transform(range(256), lambda x: list_reduce(range(8),
  lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS tab),
runs AS MATERIALIZED (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS s, w, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY ALL),
h AS MATERIALIZED (SELECT w, n, xor(list_reduce(
  list_transform(range(strlen(s)), lambda i: CAST('0x' || substr(hex(encode(s)), 2 * i + 1, 2) AS BIGINT)),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) % 256) + 1]), 4294967295), 4294967295) AS h FROM runs, t),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS MATERIALIZED (SELECT a.word, b.word AS near FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.less = v.word
  UNION SELECT v.word, d.word FROM d JOIN v ON d.less = v.word),
best AS (SELECT near.word, count(*) AS n_near, first(near.near ORDER BY v.n DESC, near.near) AS near, max(v.n) AS near_n
  FROM near JOIN v ON v.word = near.near GROUP BY near.word),
f AS MATERIALIZED (SELECT v.word, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
  CASE WHEN near_n >= 5 * v.n THEN near END AS form, CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
r AS (SELECT word, word AS at FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN r USING (word) JOIN f g ON g.word = r.at WHERE g.form IS NULL""",
}
