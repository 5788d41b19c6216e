"""Operator 2: main text of HTML pages by differencing against the page of the nearest URL.

Each page is cut into blocks of text. Within a host, pages are ordered by path;
each is paired with the neighbour whose path has the longer common beginning, their
blocks are aligned by a longest common subsequence, and shared blocks are marked.
What two neighbouring pages share is the site's frame; what differs is the text. The
differences are checked by markup: a frame that changes from page to page is still a
frame, so elements that name that role (nav, footer, aside, form and the like) go. Of
elements that are named article or main those with a block that differs are the
article, and stay whole, as a passage that two articles share is still each page's
text; those that a neighbour has as well (teasers, notices) go.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import short_batches, written
from .text import worker

# fixed values: element names of HTML, and words of class names, by what they mean here
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split())
_DROPPED = frozenset("head script style noscript template iframe object embed svg math canvas audio video map select button textarea input option datalist title dialog".split())
_FRAME = frozenset("nav footer aside form menu search fieldset".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_FRAME_WORDS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adbox adsense banner banners breadcrumb breadcrumbs comment comments comentarios kommentare commentaires consent cookie cookies disqus footer header login masthead menu menus modal nav navbar navigation newsletter notice notices overlay pagination pager popup promo promos promotion related replies reply respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription teaser toolbar widget widgets".split())
_MAIN_WORDS = frozenset("articlebody".split())

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>(?:\"[^\"]*\"|'[^']*'|[^>\"']++)*)|[^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
# fixed values: elements that hold others; a class word says what such an element is, not what a paragraph is
_HOLDERS = frozenset("aside details div dl fieldset form header footer li menu nav ol section span table td tr ul".split())

MAIN, OPEN, FRAME = 2, 1, 0


def _zone(name: str, attributes: str, inside_main: bool) -> int | None:
    """What an element says of its content: MAIN, FRAME, or None.

    A class or id says FRAME on elements that hold others, and only as a whole: each part of the
    word must be one of the list (cookie-banner, but not entry-header), and within an article
    each of its words.
    """
    if name in _FRAME or name == "header" and not inside_main:
        return FRAME
    said = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    role = said.get("role", "").lower()
    if role in _ROLES or "hidden" in said or said.get("aria-hidden") == "true":
        return FRAME
    if name in _HOLDERS:
        tokens = [_WORD.findall(_CAMEL.sub(" ", x).lower()) for x in (said.get("class", "") + " " + said.get("id", "")).split()]
        frames = _FRAME_WORDS - {"header"} if inside_main else _FRAME_WORDS
        framed = [bool(parts) and set(parts) <= frames for parts in tokens]
        if framed and (all(framed) if inside_main else any(framed)):
            return FRAME
    if name in ("article", "main") or role in ("main", "article") or said.get("itemprop", "").lower() in _MAIN_WORDS:
        return MAIN
    return None


def blocks(page: str) -> list[tuple[str, int, int]]:
    """The blocks of text of a page, in order, each with its zone and the number of the article around it (0: none); an unclosed element ends with what holds it."""
    out: list[tuple[str, int, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int, bool, int]] = []  # name, zone, whether its text is dropped, article
    zone, dropped, article, raw, articles = OPEN, False, 0, "", 0

    def flush() -> None:
        line = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if line:
            out.append((line, zone, article))

    at = 0
    for m in _MARKUP.finditer(page):
        if raw and not (m[2] and m[1] and m[2].lower() == raw):
            continue  # markup within a script and the like is text
        if m.start() > at and not dropped and not raw:
            text.append(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if name == "br":
            text.append(" ")
            continue
        if name in _BLOCK:
            flush()
        if m[1]:
            raw = ""
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    zone, dropped, article = stack[-1][1:] if stack else (OPEN, False, 0)
                    break
                if stack[i][0] in _BLOCK and (name not in _BLOCK or name == "p"):
                    break  # an inline end does not leave the block around it
            continue
        if name in _VOID or m[3].endswith("/") and name not in _BLOCK:
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and name in (x[0] for x in stack):
            _close(stack, name)
            zone, dropped, article = stack[-1][1:] if stack else (OPEN, False, 0)
        said = _zone(name, m[3], zone == MAIN)
        if said == MAIN and (zone == OPEN or zone == MAIN and name == "article"):
            articles += 1
            article = articles
        if said is not None and zone != FRAME:
            zone = said
        dropped = dropped or name in _DROPPED
        stack.append((name, zone, dropped, article))
        raw = name if name in _RAW else ""
    if not dropped and not raw:
        text.append(page[at:])
    flush()
    return out


def _close(stack: list[tuple[str, int, bool, int]], name: str) -> None:
    """Close an open paragraph, item or cell where its like begins, within what holds both."""
    holders = {"p": _BLOCK - {"p"}, "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}}.get(name, {"table", "select"})
    for i in range(len(stack) - 1, -1, -1):
        if stack[i][0] == name:
            del stack[i:]
            return
        if stack[i][0] in holders:
            return


def _lcs_rows(a: list[int], b: list[int]) -> list[int]:
    """Lengths of the longest common subsequences of all of a and each beginning of b, by bit-parallel rows."""
    size, full = len(a), (1 << len(a)) - 1
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    row, out = full, [0]
    for x in b:
        match = row & where.get(x, 0)
        row = ((row + match) | (row - match)) & full
        out.append(size - row.bit_count())
    return out


def common(a: list[int], b: list[int]) -> list[int]:
    """Positions in a of one longest common subsequence of a and b, in memory that grows with their lengths alone."""
    first = 0
    while first < len(a) and first < len(b) and a[first] == b[first]:
        first += 1
    last = 0
    while last < len(a) - first and last < len(b) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    head, tail = list(range(first)), list(range(len(a) - last, len(a)))
    inner = range(first, len(a) - last)
    theirs = set(b[first : len(b) - last])
    own = [i for i in inner if a[i] in theirs]
    ours = {a[i] for i in own}
    return head + [own[i] for i in _divide([a[i] for i in own], [x for x in b[first : len(b) - last] if x in ours])] + tail


def _divide(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    half = len(a) // 2
    left = _lcs_rows(a[:half], b)
    right = _lcs_rows(a[half:][::-1], b[::-1])[::-1]
    cut = max(range(len(b) + 1), key=lambda j: left[j] + right[j])
    return _divide(a[:half], b[:cut]) + [half + i for i in _divide(a[half:], b[cut:])]


def _address(url: str | None) -> tuple[str, str]:
    """Host and path (with what follows it) of a URL."""
    rest = (url or "").partition("://")[2] or (url or "")
    host, slash, path = rest.partition("/")
    return host.lower(), slash + path


def _hash(line: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(line) - (1 << 63)


def _same_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


_OUTLINE = pa.struct([("key", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("lines", pa.list_(pa.int64()))])
_OUTLINE_DDL = "struct<key: bigint, host: string, path: string, lines: array<bigint>>"


def _outlines(df: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """key, host, path and the hashes of the blocks that markup does not frame, of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker("pages", batches):
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                addresses = [_address(u) for u in part.column("__url").to_pylist()]
                lines = [[_hash(t) for t, *_ in _unframed(p)] for p in part.column("__html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("__key"), pa.array([h for h, _ in addresses], pa.string()), pa.array([p for _, p in addresses], pa.string()), pa.array(lines, pa.list_(pa.int64()))], ["key", "host", "path", "lines"])

    pages = df.select("__key", df[url_col].alias("__url"), df[html_col].alias("__html")).mapInArrow(run, "key long, host string, path string, lines array<long>")
    return written(pages, "outlines").dropDuplicates(["key"])


def shared_blocks(own: dict, before: dict | None, after: dict | None) -> list[int]:
    """Numbers, among its unframed blocks, of those that a page shares with the nearer of its neighbours on the same host.

    The one before comes first where both are as near; one that shares nothing gives way to the other.
    """
    near = [x for x in (before, after) if x is not None and x["host"] == own["host"]]
    for other in sorted(near, key=lambda x: -_same_start(x["path"], own["path"])):
        if out := common(own["lines"], other["lines"]):
            return out
    return []


def _differences(outlines: DataFrame) -> DataFrame:
    """key and shared (numbers among unframed blocks) for every outline with such blocks.

    Pages of a host whose unframed blocks are all the same are mirrors: the first stands for
    them, so that each is compared with the nearest page that differs.
    Outlines are dealt out by ranges of host and path and sorted, so that a host of any
    size is spread over tasks. The first and the last outline of a range lack a neighbour:
    they go on, with the one beside them, to a second step of two rows a range.
    """

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        part, before, own, first = 0, None, next(rows, None), True
        done: list[dict] = []
        while own is not None:
            part, after = own.pop("part"), next(rows, None)
            here = {k: own[k] for k in ("key", "host", "path", "lines")}
            ahead = None if after is None else {k: after[k] for k in ("key", "host", "path", "lines")}
            if first or after is None:
                done.append({"key": own["key"], "part": part, "place": (0 if first else 1), "only": first and after is None, "own": here, "beside": ahead if first else before, "shared": None})
            else:
                done.append({"key": own["key"], "part": part, "place": None, "only": False, "own": None, "beside": None, "shared": shared_blocks(here, before, ahead)})
            before, own, first = here, after, False
            if len(done) >= 512 or own is None:
                yield _batch(done)
                done = []

    def _batch(rows: list[dict]) -> pa.RecordBatch:
        kinds = {"key": pa.int64(), "part": pa.int32(), "place": pa.int32(), "only": pa.bool_(), "own": _OUTLINE, "beside": _OUTLINE, "shared": pa.list_(pa.int32())}
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], list(kinds))

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            out = []
            for r in rows:
                first = r["place"] == 0
                before, after = (r["last"], r["next"] if r["only"] else r["beside"]) if first else (r["beside"], r["next"])
                out.append(shared_blocks(r["own"], before, after))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, pa.list_(pa.int32()))], ["key", "shared"])

    outlines = outlines.where(F.size("lines") > 0).withColumn("print", F.xxhash64("lines"))
    groups = written(outlines.groupBy("host", "print").agg(F.min(F.struct("path", "key")).alias("first")).select("host", "print", F.col("first.key").alias("stands")), "page-mirrors")
    firsts = outlines.join(groups.select(F.col("stands").alias("key")), "key", "left_semi").drop("print")
    ranged = firsts.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key").withColumn("part", F.spark_partition_id())
    steps = written(ranged.mapInArrow(inner, f"key long, part int, place int, only boolean, own {_OUTLINE_DDL}, beside {_OUTLINE_DDL}, shared array<int>"), "page-pairs")
    order = Window.orderBy("part", "place")  # over two rows for each range, not over pages
    ends = steps.where(F.col("place").isNotNull()).select("key", "only", "own", "beside", "place", F.lag("own").over(order).alias("last"), F.lead("own").over(order).alias("next"))
    done = steps.where(F.col("place").isNull()).select("key", "shared").unionByName(ends.mapInArrow(outer, "key long, shared array<int>"))
    named = groups.join(done.withColumnRenamed("key", "stands"), "stands").select("host", "print", "shared")
    return outlines.select("key", "host", "print").join(written(named, "page-shares"), ["host", "print"]).select("key", "shared")


def _unframed(page: str | None) -> list[tuple[str, int, int]]:
    return [b for b in blocks(page or "") if b[1] != FRAME]


def main_text(page: str | None, shared: list[int] | None) -> str:
    """The blocks that differ from the neighbour's, without those framed by markup; ``shared``: numbers of the others among the unframed ones.

    In a page that marks articles, those with a block that differs, whole. The others go if they
    are the smaller part of the marked text: else the neighbour has the article too, and all stay.
    """
    found, gone = _unframed(page), set(shared or ())
    sizes: dict[int, int] = {}
    for text, zone, article in found:
        if zone == MAIN:
            sizes[article] = sizes.get(article, 0) + len(text)
    if not sizes:
        return "\n".join(text for i, (text, *_) in enumerate(found) if i not in gone)
    differ = {article for i, (_, zone, article) in enumerate(found) if zone == MAIN and i not in gone}
    if 2 * sum(sizes[a] for a in differ) <= sum(sizes.values()):
        differ = set(sizes)
    return "\n".join(text for text, zone, article in found if zone == MAIN and article in differ)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text and n_chars of every page.

    Null and empty html give an empty text. Pages with a null URL share the host "". Rows
    that repeat a page (id, url and html) are one page when neighbours are sought, and
    each has its row in the result. Null ids and columns not asked for do no harm.
    """
    short_batches(df.sparkSession)
    keyed = df.select(df[id_col], df[url_col], df[html_col].alias("__html"), F.xxhash64(df[id_col], df[url_col], df[html_col]).alias("__key"))
    shared = _differences(_outlines(keyed, url_col, "__html")).dropDuplicates(["key"])
    pages = keyed.join(shared, keyed["__key"] == shared["key"], "left").select(id_col, url_col, "__html", "shared")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker("pages", batches):
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [main_text(p, s) for p, s in zip(part.column("__html").to_pylist(), part.column("shared").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(id_col), part.column(url_col), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])

    types = dict(df.dtypes)
    return pages.mapInArrow(run, f"`{id_col}` {types[id_col]}, `{url_col}` {types[url_col]}, text string, n_chars long")
