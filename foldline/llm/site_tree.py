"""Main text of web pages with a site style tree.

All pages of a host are merged: elements with one path of styles (tags and class names from the root)
are one node. A node is important if its presentation varies (entropy of the child sequences seen on
the host's pages) or its content varies (a text on many of the pages has a high entropy over the pages
and so carries little). The two are combined as CompImp = (1 - g**l) * NodeImp + g**l * ContentImp for
l different presentations. Branches of low importance are removed from each page, besides what markup
already names as no article: menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, comments. Where a page marks its article (article, main), only that part is read.

The merged trees are aggregated from rows (host, path, presentation, content, page), so a host with a
third of all pages is spread over its nodes and contents; equal pages of a host count once.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_PAGES = 5
LOW_IMPORTANCE = 0.2
GAMMA = 0.9

# Element names by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = set("script style noscript template title head nav footer aside form button select option textarea iframe svg canvas object embed menu dialog audio video map datalist input label fieldset".split())
ARTICLE = {"article", "main"}
CLOSES_P = set("address article aside blockquote details div dl dt dd fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Words of class, id and role that name parts which are no article.
HINTS = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar footer masthead comment comments commentlist disqus respond replies share sharing social related recommended recommendations widget login search searchbox pagination pager skip complementary contentinfo".split())
OUTSIDE_HINTS = {"header", "site-header", "banner"}
# Elements that hold an article whatever their names say of their surroundings (has-sidebar, comments-open).
HOLDERS = {"html", "body", "main", "article"}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.IGNORECASE)


def host_of(url: str | None) -> str:
    """Lower-case host of a URL; '' for null or hostless ones."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def page_blocks(page: str) -> list[tuple[str, str, str, bool, bool, tuple[int, ...]]]:
    """(path, presentation, text, named as no article, inside a marked article, doubtful parts) of each
    text block, in page order. Text is decoded, its white space joined.

    A class, id or role that is a hint names a part that is no article; one that only has a hint among
    its words (menu-page) is doubtful: the block lists the numbers of such parts, for ``_kept``."""
    blocks: list[tuple[str, str, str, bool, bool, tuple[int, ...]]] = []
    # open elements: name, path, no article, inside article, inline, doubtful parts
    stack = [("", "", False, False, False, ())]
    text: list[str] = []
    inner: list[str] = []

    def flush():
        if text:
            joined = " ".join(entities.unescape("".join(text)).split())
            if joined:
                _, path, dropped, article, _, doubtful = stack[-1]
                blocks.append((path, ",".join(dict.fromkeys(inner)), joined, dropped, article, doubtful))
            text.clear()
        inner.clear()

    def pop_to(index):
        if any(not e[4] for e in stack[index:]):
            flush()
        del stack[index:]

    at = 0
    while True:
        tag = TAG.search(page, at)
        if tag is None:
            text.append(page[at:])
            break
        if tag.start() > at:
            text.append(page[at: tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    pop_to(i)
                    break
                if name in INLINE and not stack[i][4]:
                    break
            continue
        if name == "br":
            text.append(" ")
            continue
        if name == "hr":
            flush()
            continue
        if name in RAW:
            at = _skip(page, at, name)
            continue
        inline = name in INLINE
        if not inline:
            if name in CLOSES_P or name in SELF_CLOSING:
                stop = LIMITS.get(name, ())
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in SELF_CLOSING.get(name, ()) or stack[i][0] == "p":
                        pop_to(i)
                        if stack[-1][0] not in SELF_CLOSING.get(name, ()):
                            break
                    elif stack[i][0] in stop or (not stop and not stack[i][4]):
                        break
            flush()
        _, path, dropped, article, _, doubtful = stack[-1]
        label, words, names = name, set(), set()
        attributes = tag[3]
        if attributes.strip():
            for key, *values in ATTRIBUTE.findall(attributes):
                value = "".join(values).lower()
                key = key.lower()
                if key == "hidden" or (key == "aria-hidden" and value == "true"):
                    dropped = True
                elif key == "class":
                    label += "." + re.sub(r"[0-9]+", "", value)
                if key in ("class", "id", "role"):
                    words.update(re.split(r"[^a-z]+", value))
                    names.update(value.split())
        if name in VOID:
            if name in ("img", "input"):
                inner.append(name)
            continue
        dropped = dropped or name in NEVER
        if name not in HOLDERS:
            dropped = dropped or not names.isdisjoint(HINTS)
            if not article and (name == "header" or not (names | words).isdisjoint(OUTSIDE_HINTS)):
                dropped = True
            if not dropped and not words.isdisjoint(HINTS):
                if inline:
                    dropped = True
                else:
                    doubtful = (*doubtful, at)
        article = article or name in ARTICLE
        if inline:
            inner.append(name)
            if dropped and not stack[-1][2]:
                text.append(" ")
                end = _skip(page, at, name)
                at = at if end == len(page) else end  # without an end tag nothing is left out
                continue
        stack.append((name, path if inline else f"{path}/{label}", dropped, article, inline, doubtful))
    flush()
    return blocks


def _skip(page: str, at: int, name: str) -> int:
    """Behind the end tag that follows, or the page's end."""
    end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
    return len(page) if end is None else end.end()


def _code(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _kept(blocks):
    """Blocks that the markup does not exclude: those of the marked article, if it has any text. A
    doubtful part goes unless it holds most of the text or the marked article: then it is a wrapper."""
    rest = [b for b in blocks if not b[3]]
    if any(b[5] for b in rest):
        total, own, wrappers = 0, {}, set()
        for b in rest:
            total += len(b[2])
            for part in b[5]:
                own[part] = own.get(part, 0) + len(b[2])
        wrappers = {part for part, size in own.items() if 2 * size > total}
        marked = [set(b[5]) for b in rest if b[4]]
        if marked:
            wrappers |= set.intersection(*marked)
        rest = [b for b in rest if wrappers.issuperset(b[5])]
    return [b for b in rest if b[4]] or rest


def tree_rows(pages: DataFrame) -> DataFrame:
    """(host, path, style, content, page) codes of the blocks that markup leaves, each once a page."""

    def run(batches):
        for batch in batches:
            hosts, rows = [], []
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = page.as_py() or ""
                host, own = host_of(url), _code(page)
                found = {(_code(b[0]), _code(b[1]), _code(b[2]), own) for b in _kept(page_blocks(page))}
                rows.extend(found)
                hosts.extend([host] * len(found))
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
                ["host", "path", "style", "content", "page"])

    return pages.select("url", "html").mapInArrow(run, "host string, path long, style long, content long, page long")


def low_branches(pages: DataFrame) -> DataFrame:
    """(host, paths): the paths of each host's merged tree that carry little on at least MIN_PAGES
    different pages. Hosts without such paths are left out."""
    rows = tree_rows(pages).distinct()
    contents = rows.groupBy("host", "path", "content").agg(F.count_distinct("page").alias("n"))
    content = contents.groupBy("host", "path").agg(F.count("*").alias("k"), F.sum(F.log("n")).alias("s"))
    styles = rows.select("host", "path", "style", "page").distinct().groupBy("host", "path", "style").count()
    style = styles.groupBy("host", "path").agg(
        F.count("*").alias("l"), F.sum("count").alias("t"), F.sum(F.col("count") * F.log("count")).alias("c"))
    seen = rows.select("host", "path", "page").distinct().groupBy("host", "path").agg(F.count("*").alias("m"))
    nodes = seen.where(F.col("m") >= MIN_PAGES).join(content, ["host", "path"]).join(style, ["host", "path"])
    node = (F.log("t") - F.col("c") / F.col("t")) / F.log("m")
    carried = 1 - F.col("s") / F.col("k") / F.log("m")
    fade = F.pow(F.lit(GAMMA), F.col("l"))
    low = nodes.where((1 - fade) * node + fade * carried < LOW_IMPORTANCE)
    return low.groupBy("host").agg(F.array_sort(F.collect_list("path")).alias("paths"))


def main_text(page: str, low: set[int]) -> str:
    """The page's kept blocks, without low branches unless these hold most of its text."""
    blocks = _kept(page_blocks(page))
    if low:
        rest = [b for b in blocks if _code(b[0]) not in low]
        if 2 * sum(len(b[2]) for b in rest) >= sum(len(b[2]) for b in blocks):
            blocks = rest
    return "\n\n".join(b[2] for b in blocks)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html).

    Null html is an empty page; a page without article text gives ''. Null or hostless urls form one
    host. Repeated rows give equal rows; broken markup is read as browsers mostly do (unclosed
    elements end with their parent, an unclosed comment or script runs to the end). An empty table
    gives an empty result; other columns are not read."""
    rows = pages.select("page_id", "url", "html")
    rules = materialize(low_branches(rows), "site-rules")

    def hosts(batches):
        for batch in batches:
            names = pa.array([host_of(u) for u in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, names], ["page_id", "url", "html", "_host"])

    kind = rows.schema["page_id"].dataType.simpleString()
    if rules.isEmpty():
        joined = rows.withColumn("paths", F.lit(None).cast("array<bigint>"))
    else:
        named = rows.mapInArrow(hosts, f"page_id {kind}, url string, html string, _host string")
        joined = named.join(rules, named["_host"] == rules["host"], "left").select("page_id", "url", "html", "paths")

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py() or "", set(low.as_py() or ())) for p, low in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
