"""Main text of web pages: structure of the page, and differences to the page with the nearest URL.

``blocks`` reads a page into blocks of text, each of one of three kinds:

* article: inside an ``article`` element (without one: ``main`` or role main), outside of everything below;
* furniture: inside menus, headers, footers, sidebars, notices, adverts, forms, reader comments or hidden
  elements, by tag, role or words of class and id; scripts and styles make no block at all;
* open: the rest, such as the body of a page without an article element, and parts of an article whose id alone
  names furniture that may as well be a topic (``TOPICS``).

Inside an article or ``main``, words say less: headings are never furniture by class or id, paragraphs, cells and elements inside a line only by a
whole class name (inside a line: one that names adverts), as "notice-period" is no notice, and an id, often made from a heading, only as a whole and on containers. Formulas (``math``) are text without their annotations.

``extract`` pairs every page with the one of the same host whose path shares the longest prefix with its own: in
the order of paths that is a neighbour. The lines of both pages are aligned by their longest common
subsequence, and open blocks on it, which the two pages share, are deleted. Article blocks stay, also where two pages
are copies of each other; differences alone would delete those, and keep menus that change
from page to page.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined in page
order by a line feed. ``br`` counts as white space. Headings stay when they are in an article's own header.

Scale: only page ids, paths and 8-byte hashes of lines are sorted and written down; the neighbours across
the ends of sorted partitions come from those partitions' first and last rows. Texts are shuffled once, compressed, to meet the lines of
their neighbour. A host of any size is spread over many partitions, as the order goes on below it.

Rows: null or empty html gives the empty text. Pages with null urls, or without a host, belong to the host ''. Ties
in the order go to the earlier neighbour. Repeated rows get the same text each; rows that share an id but differ are
told apart. Null ids are kept. An empty table gives an empty table. Very long pages are aligned in linear memory. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tarmac.session import stored

ARTICLE, OPEN, FURNITURE = 2, 1, 0

#: fixed values: element names of HTML by what they mean here
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var "
    "math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac msqrt mroot mover munder munderover mtable mtr mtd mstyle mpadded mphantom "
    "mfenced menclose mmultiscripts mprescripts".split()
)
DROPPED = set(
    "nav footer aside form script style head title template noscript iframe svg object select button textarea "
    "annotation annotation-xml canvas audio video dialog menu applet frameset".split()
)
#: dropped ones that stand inside a line of text and do not end its block
INLINE_DROPPED = set("script style template noscript iframe svg object select button textarea canvas audio video annotation annotation-xml".split())
RAW = set("script style textarea title noembed noframes xmp iframe".split())
IN_HEAD = set("base link meta title style script noscript template".split())
CLOSES_ITSELF = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"},
}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: fixed values: words of class, id and role that name furniture
FURNITURE_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
FURNITURE_WORDS = re.compile(
    "ad|ads|adbox|adslot|adunit|adsense|advert.*|sponsor|sponsors|sponsored|promo|promos|promotion|banner|cookie.*|consent|gdpr|"
    "notice|notices|alert|alerts|.*sidebar|.*menu|.*nav|nav.*|breadcrumb.*|masthead|.*footer|footer.*|"
    "comments?|comment(list|form|box|area|section|thread)s?|disqus|share|sharing|sharebar|social|related|recommended|recommendations|"
    "newsletter.*|subscribe|subscription|popup|modal|overlay|widget|widgets|toolbar|pagination|pager|login|signup|search|searchform"
)
#: fixed values: those of them that name adverts, and those that, as the id of a part of an article, may be its topic
ADVERT_WORDS = re.compile("ad|ads|adbox|adslot|adunit|adsense|advert.*|sponsor|sponsors|sponsored|promo|promos")
TOPICS = set(
    "promotion banner consent gdpr notice notices alert alerts share sharing social related recommended recommendations "
    "subscription popup modal overlay widget widgets toolbar pagination pager login signup search navigation".split()
)
#: fixed values: elements of running text
TEXT_ELEMENTS = set("p li dd dt td th caption figcaption figure blockquote pre table tr tbody thead summary address".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _named(name: str, given: dict[str, str]) -> tuple[bool, bool]:
    """Whether class and id words of an element inside an article make it furniture, and whether they may be its topic as well."""
    if name in HEADINGS:
        return False, False
    classes = ["".join(re.findall(r"[a-z]+", c)) for c in given.get("class", "").lower().split()]
    if name in INLINE:
        return any(map(ADVERT_WORDS.fullmatch, classes)), False
    if name in TEXT_ELEMENTS:
        return any(map(FURNITURE_WORDS.fullmatch, classes)), False
    words = re.findall(r"[a-z]+", given.get("class", "").lower())
    if any(map(FURNITURE_WORDS.fullmatch, {*words, *map("".join, zip(words, words[1:]))})):
        return True, False
    ident = "".join(re.findall(r"[a-z]+", given.get("id", "").lower()))
    return FURNITURE_WORDS.fullmatch(ident) is not None and ident not in TOPICS, ident in TOPICS


def _furniture(name: str, attributes: str, inside: bool = False) -> tuple[bool, bool, bool, bool, bool]:
    """Whether an element is furniture, whether it is a header (whose headings may stay), whether it has role main, whether
    only a class word or being a form makes it furniture, and whether it is a part of an article (``inside``) that may be furniture or a topic."""
    if name == "header":
        return True, True, False, False, False
    if not attributes.strip(" /\t\r\n"):
        return name in DROPPED, False, False, name == "form", False
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if (name in DROPPED and name != "form") or "hidden" in given or given.get("aria-hidden") == "true":
        return True, False, False, False, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I):
        return True, False, False, False, False
    role = given.get("role", "").lower()
    if role in FURNITURE_ROLES:
        return True, False, False, False, False
    if name == "form":
        return True, False, False, True, False
    if name in ("html", "body"):
        return False, False, False, False, False
    words = re.findall(r"[a-z]+", f"{given.get('class', '')} {given.get('id', '')}".lower())
    # an article inside another or in main is judged as any wrapper
    if inside and name != "article":
        furniture, topic = _named(name, given)
    else:
        furniture, topic = any(map(FURNITURE_WORDS.fullmatch, {*words, *map("".join, zip(words, words[1:]))})), False
    if furniture:
        return True, False, role == "main", True, False
    header = "header" in words and name not in HEADINGS and not (inside and name in INLINE | TEXT_ELEMENTS)
    return header, header, role == "main", False, topic


class _Reader:
    """The open elements of a page and the block that is being read.

    An element's state is whether its text is furniture, whether only a header makes it so, whether it is in an
    article, whether it is in a main element, whether it is furniture inside a line, which says nothing at all, whether it is
    furniture by more than class words or forms, how many of those two are around it outside articles, and whether it is in a
    part of an article that only differences can judge. With ``lenient``, an article or main element is
    not furniture because of such wrappers.
    """

    def __init__(self, lenient: bool):
        self.lenient = lenient
        self.names: list[str] = []
        self.states: list[tuple[bool, bool, bool, bool, bool, bool, int, bool]] = []
        self.found: list[tuple[str, tuple, bool]] = []
        self.buffer: list[str] = []
        self.headings = 0
        self.begun: tuple = ()

    def state(self) -> tuple[bool, bool, bool, bool, bool, bool, int, bool]:
        return self.states[-1] if self.states else (False, False, False, False, False, False, 0, False)

    def text(self, text: str) -> None:
        if not self.state()[4]:
            if not self.buffer:
                self.begun = (self.state(), self.headings > 0)
            self.buffer.append(text)

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                self.found.append((text, *self.begun))

    def close(self, place: int) -> None:
        if self.names[place] not in INLINE and self.names[place] not in INLINE_DROPPED:
            self.flush()
        self.headings -= sum(n in HEADINGS for n in self.names[place:])
        del self.names[place:], self.states[place:]

    def end(self, name: str) -> None:
        inline = name in INLINE or name in INLINE_DROPPED
        for place in range(len(self.names) - 1, -1, -1):
            if self.names[place] == name:
                self.close(place)
                return
            if inline and self.names[place] not in INLINE and self.names[place] not in INLINE_DROPPED:
                return

    def start(self, name: str, attributes: str) -> None:
        inline = name in INLINE or name in INLINE_DROPPED
        if not inline:
            self.flush()
        if self.names and self.names[-1] == "head" and name not in IN_HEAD:
            self.close(len(self.names) - 1)
        if name == "p" or name in CLOSES_ITSELF:
            for place in range(len(self.names) - 1, -1, -1):
                if self.names[place] == name:
                    self.close(place)
                    break
                if self.names[place] in CLOSES_ITSELF.get(name, ()) or (name == "p" and self.names[place] not in INLINE):
                    break
        outer = self.state()
        furniture, header, role_main, weak, topic = _furniture(name, attributes, outer[2] or outer[3])
        opens = (name == "article" and not outer[2]) or ((name == "main" or role_main) and not outer[3])
        above = outer[0] and not (self.lenient and opens and not outer[5])
        by_header = outer[1] and not (furniture and not header) if above else furniture and header
        self.names.append(name)
        self.states.append((
            above or furniture, by_header, outer[2] or name == "article", outer[3] or name == "main" or role_main, outer[4] or (furniture and inline),
            outer[5] or (furniture and not weak), outer[6] + (furniture and weak and not outer[2]),
            outer[7] or topic,
        ))
        self.headings += name in HEADINGS


def blocks(html: str | None) -> tuple[list[str], list[int]]:
    """Texts and kinds of a page's blocks, in page order.

    If no article or main element is left beside the furniture, those in wrappers that only a class word or a form makes furniture count:
    the ones with the fewest such wrappers.
    """
    page = _read(html or "", False)
    kinds = _kinds(page)
    in_main = any(state[3] and k != FURNITURE for (_, state, _), k in zip(page.found, kinds))
    if ARTICLE not in kinds and not in_main and any((state[2] or state[3]) and state[6] and not state[5] for _, state, _ in page.found):
        page = _read(html or "", True)
        kinds = _kinds(page)
        least = min((state[6] for (_, state, _), k in zip(page.found, kinds) if k == ARTICLE), default=0)
        kinds = [FURNITURE if k == ARTICLE and state[6] > least else k for (_, state, _), k in zip(page.found, kinds)]
    return [t for t, _, _ in page.found], kinds


def _read(html: str, lenient: bool) -> _Reader:
    page, at = _Reader(lenient), 0
    while at < len(html):
        token = _TOKEN.search(html, at)
        text = html[at : token.start() if token else len(html)]
        if text:
            page.text(unescape(text))
        if token is None:
            break
        at = token.end()
        if token[2] is None:
            continue
        name = token[2].lower()
        if name == "br":
            page.text(" ")
        elif token[1]:
            page.end(name)
        elif name == "hr":
            page.flush()
        elif name not in VOID:
            page.start(name, token[3])
            if name in RAW:
                stop = re.compile(f"</{re.escape(name)}", re.I).search(html, at)
                at = stop.start() if stop else len(html)
    page.flush()
    return page


def _kinds(page: _Reader) -> list[int]:
    inside = 2 if any(state[2] and (state[1] or not state[0]) for _, state, _ in page.found) else 3
    kinds = []
    for _, state, in_heading in page.found:
        kept_heading = state[1] and in_heading and state[inside]
        kinds.append(FURNITURE if state[0] and not kept_heading else ARTICLE if state[inside] and not state[7] else OPEN)
    return kinds


# --- alignment ----------------------------------------------------------------------------------------------------

#: cells of the table that an alignment may keep at once, as bits
TABLE_BITS = 1 << 28


def _rows(a: list, b: list, keep: bool) -> list[int]:
    """Rows of the table of common lengths as bits, one per line of ``a`` (only the last unless ``keep``); a cleared bit is a step."""
    full, masks = (1 << len(b)) - 1, {}
    for j, line in enumerate(b):
        masks[line] = masks.get(line, 0) | 1 << j
    row, rows = full, []
    for line in a:
        hit = row & masks.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and every prefix of ``b``."""
    row = _rows(a, b, False)[0].to_bytes(len(b) // 8 + 1, "little")
    steps = 1 - np.unpackbits(np.frombuffer(row, np.uint8), bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate(([0], np.cumsum(steps)))


def shared_lines(a: list, b: list) -> list[int]:
    """Indices of the lines of ``a`` on a longest common subsequence with ``b``."""
    found, work = [], [(0, len(a), 0, len(b))]
    while work:
        i, m, j, n = work.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append(i)
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append(m)
        if i == m or j == n:
            continue
        if m - i > 1 and (m - i) * (n - j) > TABLE_BITS:
            half = (i + m) // 2
            ahead = _lengths(a[i:half], b[j:n])
            behind = _lengths(a[half:m][::-1], b[j:n][::-1])[::-1]
            cut = j + int(np.argmax(ahead + behind))
            work += [(i, half, j, cut), (half, m, cut, n)]
            continue
        rows = _rows(a[i:m], b[j:n], True)
        p, q = m - i, n - j
        while p and q:
            if a[i + p - 1] == b[j + q - 1]:
                p, q = p - 1, q - 1
                found.append(i + p)
                continue
            below = (1 << q) - 1
            # the common lengths without the last line of a, and without the last line of b
            up = q - (rows[p - 2] & below).bit_count() if p > 1 else 0
            left = q - 1 - (rows[p - 1] & (below >> 1)).bit_count()
            p, q = (p - 1, q) if up >= left else (p, q - 1)
    return sorted(found)


# --- pages --------------------------------------------------------------------------------------------------------


def host_and_path(url: str | None) -> tuple[str, str]:
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return host.lower(), re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]


def _line_hashes(lines: list[str]) -> list[int]:
    return [xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63) for line in lines]


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def neighbours(pages: DataFrame) -> DataFrame:
    """``id``, ``mark`` of every distinct page (columns id, mark, host, path) that has a neighbour on its host, and its
    nearest one's ``near_id``, ``near_mark``. Pages of equal ``content``, a column that may be missing or null, are no neighbours.

    In order of paths, pages of one host and content that follow each other are a run; the nearest page is the last one of
    the run before or the first one of the run after.
    """
    spark = pages.sparkSession
    kind = pages.schema["id"].dataType.simpleString()
    order = ["host", "path", "id", "mark"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = f"struct<host:string,path:string,id:{kind},mark:bigint,content:bigint>"
    if "content" not in pages.columns:
        pages = pages.withColumn("content", F.lit(None).cast("bigint"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, run = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            runs = []
            for host, content in zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()):
                if content is None or (host, content) != last:
                    run += 1
                last = (host, content)
                runs.append(run)
            rows = batch.to_struct_array()
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), pa.array(runs, pa.int64()), rows], ["part", "run", "row"])

    ranked = stored(
        pages.select(*order, "content").repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(rank, f"part int, run bigint, row {row}"), "url-order"
    )
    of_part = Window.partitionBy("part")
    runs = ranked.groupBy("part", "run").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    runs = stored(runs.withColumn("final", F.max("run").over(of_part)), "url-runs")
    # four runs per sorted partition at most: neighbours that its first and last run miss are in the partitions beside
    edges: dict[int, list] = {}
    for edge in sorted(runs.where("run <= 1 or run >= final - 1").collect(), key=lambda r: (r["part"], r["run"])):
        edges.setdefault(edge["part"], []).append(edge)
    same_run = lambda a, b: a["content"] is not None and (a["host"], a["content"]) == (b["host"], b["content"])
    missing, part_kind = [], f"part int, edge_before {row}, edge_after {row}"
    for part, own in edges.items():
        before = next((x["last"] for p in sorted((p for p in edges if p < part), reverse=True) for x in reversed(edges[p]) if not same_run(x["last"], own[0]["first"])), None)
        after = next((x["first"] for p in sorted(p for p in edges if p > part) for x in edges[p] if not same_run(x["first"], own[-1]["last"])), None)
        missing.append((part, before, after))
    by_run = of_part.orderBy("run")
    beside = runs.join(F.broadcast(spark.createDataFrame(missing, part_kind)), "part").select(
        "part", "run", F.when(F.col("run") == 0, F.col("edge_before")).otherwise(F.lag("last").over(by_run)).alias("before"),
        F.when(F.col("run") == F.col("final"), F.col("edge_after")).otherwise(F.lead("first").over(by_run)).alias("after"),
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chosen = []
            for here, before, after in zip(*(batch.column(i).to_pylist() for i in range(3))):
                beside = [x for x in (before, after) if x and x["host"] == here["host"]]
                if beside:
                    near = max(beside, key=lambda x: _common(x["path"], here["path"]))
                    chosen.append((here["id"], here["mark"], near["id"], near["mark"]))
            ids = batch.schema[0].type.field("id").type
            columns = list(zip(*chosen)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (ids, pa.int64(), ids, pa.int64()))], ["id", "mark", "near_id", "near_mark"]
            )

    return ranked.join(beside, ["part", "run"]).select("row", "before", "after").mapInArrow(choose, f"id {kind}, mark bigint, near_id {kind}, near_mark bigint")


def _packed(texts: list[str]) -> bytes:
    """The blocks of a page, none of which has a line feed, in the fewest bytes: they are most of what is shuffled."""
    return zlib.compress("\n".join(texts).encode("utf-8", "surrogatepass"), 1)


def _unpacked(data: bytes, kinds: bytes) -> list[str]:
    return zlib.decompress(data).decode("utf-8", "surrogatepass").split("\n") if kinds else []


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text``, ``n_chars``, ``n_blocks`` and ``n_shared`` (blocks on the alignment) of every page."""
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    given = given.withColumn("mark", F.xxhash64("url", "html"))
    kind = given.schema["id"].dataType.simpleString()

    def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [host_and_path(u) for u in batch.column(1).to_pylist()]
            pairs = [blocks(h) for h in batch.column(2).to_pylist()]
            lines = [_line_hashes(texts) for texts, _ in pairs]
            # copies say nothing about each other's open lines; pages without such lines are compared with any other
            opens = [[x for x, k in zip(found, kinds) if k == OPEN] for found, (_, kinds) in zip(lines, pairs)]
            contents = [xxhash.xxh64_intdigest(np.array(o, np.int64).tobytes()) - (1 << 63) if o else None for o in opens]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array([p[0] for p in places], pa.string()), pa.array([p[1] for p in places], pa.string()), pa.array(lines, pa.list_(pa.int64())), pa.array(contents, pa.int64())],
                ["id", "mark", "host", "path", "lines", "content"],
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [blocks(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array([_packed(p[0]) for p in pairs], pa.binary()), pa.array([bytes(p[1]) for p in pairs], pa.binary())],
                ["id", "url", "mark", "texts", "kinds"],
            )

    outlines = stored(given.mapInArrow(outline, f"id {kind}, mark bigint, host string, path string, lines array<bigint>, content bigint"), "page-lines")
    distinct = outlines.dropDuplicates(["id", "mark"])
    near = neighbours(distinct)
    lines = distinct.select(F.col("id").alias("near_id"), F.col("mark").alias("near_mark"), F.col("lines").alias("near_lines"))
    same = lambda a, b: a.eqNullSafe(b)
    beside = near.alias("n").join(lines.alias("l"), same(F.col("n.near_id"), F.col("l.near_id")) & (F.col("n.near_mark") == F.col("l.near_mark"))).select(
        F.col("n.id").alias("of_id"), F.col("n.mark").alias("of_mark"), "near_lines"
    )
    texts = given.mapInArrow(read, f"id {kind}, url string, mark bigint, texts binary, kinds binary")
    both = texts.join(beside, same(F.col("id"), F.col("of_id")) & (F.col("mark") == F.col("of_mark")), "left").select("id", "url", "texts", "kinds", "near_lines")

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, kinds, near_lines in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                texts = _unpacked(data, kinds)
                shared = set(shared_lines(_line_hashes(texts), near_lines)) if near_lines else set()
                kept = [t for i, (t, k) in enumerate(zip(texts, kinds)) if k == ARTICLE or (k == OPEN and i not in shared)]
                # a page whose lines are all part of another page keeps them
                kept = kept or [t for t, k in zip(texts, kinds) if k == OPEN]
                text = "\n".join(kept)
                rows.append((text, len(text), len(texts), len(shared)))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64())))],
                ["id", "url", "text", "n_chars", "n_blocks", "n_shared"],
            )

    done = both.mapInArrow(difference, f"id {kind}, url string, text string, n_chars bigint, n_blocks bigint, n_shared bigint")
    return done.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars", "n_blocks", "n_shared")
