"""Main text of web pages: markup to blocks, and differencing with the nearest page of the host.

A page is read into blocks of text. Scripts, menus, footers, forms and parts whose
whole name marks them as adverts, notices or comments are left out. All that
remains, inside an article or main element or not, is compared with the page of
nearest URL on the same host that has another body: both pages' lines are aligned
by their longest common subsequence, and shared lines are deleted as the template's
if most of the pages beside have them too.
Equal bodies stand as one in the order of URLs, and a page whose lines are nearly
the same (`COPY`) is passed over, so copies of a story do not delete each other.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amperline.llm.common import record_batch, small_batches
from amperline.session import durable

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""["'>]""")
#: Elements whose content is no markup; each runs to its end tag, or to the end of the page.
_RAW = {
    name: re.compile(rf"</{name}\s*>", re.I)
    for name in ("script", "style", "noscript", "template", "iframe", "textarea", "svg", "title")
}
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# Elements that hold no main text, elements that end a block, elements without an end,
# and the words in a class, id or role that name a part as something else than main text.
OTHER = frozenset("head nav footer aside form button select dialog menu object canvas audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "notice notices sidebar menu nav navbar navigation breadcrumb breadcrumbs footer contentinfo complementary "
    "comment comments disqus social share sharing related subscribe newsletter popup modal login search".split()
)

PLAIN, MAIN = 1, 2
#: Neighbours of each side that are looked at, and the Jaccard similarity of lines from which a page is a copy.
BESIDE, COPY = 3, 0.7


def _role(tag: str, attributes: str, outer: int) -> int:
    """What text inside an element is: 0 left out, 1 plain, 2 main."""
    if tag in OTHER:
        return 0
    if tag in ("article", "main"):
        return MAIN
    if tag not in ("html", "body"):
        for match in _NAMED.finditer(attributes):
            value = next(v for v in match.groups() if v is not None)
            for name in value.lower().split():
                # a name that has other words as well (has-sidebar) does not say what the element is
                if MARKED.issuperset(re.split(r"[_-]+", name)):
                    return 0
    if tag == "header" and outer != MAIN:
        return 0
    return outer


def markup(html: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Start, end, whether it closes, name and attributes of all markup, in page order.

    Comments, declarations and elements without markup inside have no name. A "<" that
    begins no tag, or after which no ">" follows, is text. A tag whose quotes do not
    close ends at its first ">"; quotes count no more in the rest of such a page. Every
    character is looked at a fixed number of times, however broken the page is.
    """
    last = {mark: html.rfind(mark) for mark in "\"'>"}
    quotes, at = True, html.find("<")
    while 0 <= at < last[">"]:
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            end = len(html) if end < 0 else end + 3
            yield at, end, False, "", ""
        elif html[at + 1] in "!?":
            end = html.index(">", at) + 1
            yield at, end, False, "", ""
        elif tag := _TAG.match(html, at):
            end = stop = tag.end()
            while quotes:
                stop = _STOP.search(html, stop).start() if stop <= last[">"] else -1
                if stop < 0 or html[stop] == ">":
                    break
                mark = html[stop]
                stop = html.index(mark, stop + 1) + 1 if stop < last[mark] else -1
                if stop < 0:
                    break
            if not quotes or stop < 0:
                quotes, stop = False, html.index(">", end)
            name = tag.group(2).lower()
            attributes, end = html[end:stop], stop + 1
            if name in _RAW and not tag.group(1):
                close = _RAW[name].search(html, end)
                end, name = close.end() if close else len(html), ""
            yield at, end, bool(tag.group(1)), name, attributes
        else:
            end = at + 1
        at = html.find("<", end)
    if at >= 0 and (at := html.find("<!--", at)) >= 0:
        yield at, len(html), False, "", ""


def blocks_of(html: str | None) -> list[tuple[int, str]]:
    """Role and text of every block that is not left out, in page order."""
    out: list[tuple[int, str]] = []
    open_tags: list[tuple[str, int]] = []
    role, pieces, start = PLAIN, [], 0
    html = html or ""

    def end_block() -> None:
        text = " ".join("".join(pieces).split())
        if text and role:
            out.append((role, text))
        pieces.clear()

    depth: Counter[str] = Counter()
    for begin, end, closes, tag, attributes in markup(html):
        if begin > start:
            pieces.append(unescape(html[start:begin]))
        start = end
        if not tag:
            continue
        if tag in BLOCKS:
            end_block()
        elif tag == "br":
            pieces.append(" ")
        if tag in VOID:
            continue
        inner = role
        if not closes:
            # an article that begins inside an unclosed menu or advert is none of it
            base = PLAIN if tag in ("article", "main") and not role and open_tags else role
            inner = _role(tag, attributes, base) if role or base else 0
            open_tags.append((tag, role))
            depth[tag] += 1
        elif depth[tag]:
            closed = ""
            while closed != tag:
                closed, inner = open_tags.pop()
                depth[closed] -= 1
        if inner != role:
            end_block()
            role = inner
    if start < len(html):
        pieces.append(unescape(html[start:]))
    end_block()
    return out


def shared_lines(mine: list[int], other: list[int]) -> set[int]:
    """Positions of `mine` in a longest common subsequence with `other`."""
    places: dict[int, list[int]] = {}
    for at, line in enumerate(other):
        places.setdefault(line, []).append(at)
    ends: list[int] = []
    links: list[tuple] = []
    for at, line in enumerate(mine):
        for place in reversed(places.get(line, ())):
            size = bisect_left(ends, place)
            link = (at, links[size - 1] if size else None)
            if size == len(ends):
                ends.append(place)
                links.append(link)
            elif place < ends[size]:
                ends[size], links[size] = place, link
    found, link = set(), links[-1] if links else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def is_copy(mine: list[int], other: list[int]) -> bool:
    """Whether two pages have nearly the same lines."""
    ours, theirs = set(mine), set(other)
    return len(ours & theirs) >= COPY * len(ours | theirs)


def template_lines(mine: list[int], others: list[list[int]]) -> list[int]:
    """Positions of the lines that a page shares with the nearest of the others that is no copy.

    A template prints its lines on every page. So a line must also be in two thirds of
    all the others that are no copies; what a few pages have in common is main text.
    """
    different = [other for other in others if not is_copy(mine, other)]
    if not different:
        return []
    holders = Counter(line for other in different for line in set(other))
    return sorted(at for at in shared_lines(mine, different[0]) if 3 * holders[mine[at]] >= 2 * len(different))


def read_pages(pages: DataFrame) -> DataFrame:
    """Lines of every page with a key of all of them, host and path."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("lines", pa.list_(pa.string()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            lines = [[text for _, text in blocks_of(h)] for h in batch.column("html").to_pylist()]
            yield record_batch(schema, batch.column("page_id"), batch.column("url"), lines)

    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    found = narrow.mapInArrow(read, "page_id long, url string, lines array<string>")
    address = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)"
    return found.withColumns(
        {
            "body": F.xxhash64(F.array_join("lines", "\n")),
            "host": F.lower(F.coalesce(F.regexp_extract("url", address, 1), F.lit(""))),
            "path": F.coalesce(F.regexp_extract("url", address, 2), F.lit("")),
        }
    )


def lines_to_delete(read: DataFrame) -> DataFrame:
    """For each body of a host with lines of the template, the positions of these lines; stored.

    Only hashes of lines are exchanged. A body stands at its first URL. All are numbered in the order of host and path,
    sorted by range, so a host of any size is cut over many tasks, and neighbours
    meet by number; therefore the result does not depend on where the cuts are.
    """
    bodies = (
        read.filter((F.col("host") != "") & (F.size("lines") > 0))
        .select("host", "body", "path", F.transform("lines", lambda x: F.hash(x)).alias("mine"))
        .groupBy("host", "body")
        .agg(F.min(F.struct("path", "mine")).alias("first"))
        .select("host", "body", "first.*")
    )
    sliced = durable(bodies.repartitionByRange("host", "path", "body").withColumn("part", F.spark_partition_id()))
    sizes = sliced.groupBy("part").agg(F.count("*").alias("size"))
    # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("host", "path", "body")
    placed = durable(
        sliced.withColumn("row", F.row_number().over(inside))
        .join(offsets, "part")
        .select("host", "path", "body", "mine", (F.col("offset") + F.col("row")).alias("at"))
    )
    steps = F.explode(F.array(*[F.lit(i) for i in range(-BESIDE, BESIDE + 1) if i]))
    asked = placed.select("host", "path", "body", "at", steps.alias("step")).withColumn("at", F.col("at") + F.col("step"))
    others = placed.select("at", F.col("host").alias("its"), F.col("path").alias("there"), F.col("mine").alias("other"))
    beside = asked.join(others, "at").filter("host = its")
    # paths further apart than this count alike, then the order of URLs decides
    far = F.levenshtein("path", "there", 64)
    near = F.struct(F.when(far < 0, 65).otherwise(far).alias("far"), F.abs("step").alias("apart"), "step", "other")
    others = beside.groupBy("host", "body").agg(F.sort_array(F.collect_list(near)).getField("other").alias("others"))
    schema = pa.schema([("host", pa.string()), ("body", pa.int64()), ("gone", pa.list_(pa.int32()))])

    def differed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("mine").to_pylist(), batch.column("others").to_pylist(), strict=True)
            gone = [template_lines(mine, several) for mine, several in rows]
            kept = pa.array([bool(g) for g in gone])
            yield record_batch(schema, batch.column("host"), batch.column("body"), gone).filter(kept)

    compared = placed.select("host", "body", "mine").join(others, ["host", "body"])
    return durable(compared.mapInArrow(differed, "host string, body long, gone array<int>"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page, or one without main text, has the empty text. A page
    without a host, or with no other body than copies of its own beside it, is
    compared with no other. Repeated rows are pages of their own, with equal texts.
    Columns other than page_id, url and html are not read. Pages are read twice, for
    the comparison and for the text, which is cheaper than to store all texts between.
    """
    gone = lines_to_delete(read_pages(pages))
    kept = F.filter("lines", lambda _, at: ~F.array_contains("gone", at))
    lines = F.when(F.col("gone").isNull(), F.col("lines")).otherwise(kept)
    texts = read_pages(pages).join(gone, ["host", "body"], "left")
    found = texts.select("page_id", "url", F.array_join(lines, "\n").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
