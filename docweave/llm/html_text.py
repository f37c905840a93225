"""Wrapper induction: main text of web pages by aligning pages of one host.

Each page becomes a tree of elements (siblings of one label fold into one slot).
Pages of one host are aligned to a common wrapper tree by simple tree matching:
equal labels match, children match by the order-keeping pairing of greatest
weight, and what the wrapper lacks is added to it. Then every page is aligned to
its host's wrapper, and for each slot and text the pages that hold it are
counted. A text that a share of the host's pages have in the same slot is a
constant node, and template; slots whose text varies are content. Elements whose
tag or class name names a role (menus, page headers, footers, adverts, forms,
notices, comments and so on) are template in any case, since their text varies too.

1. Wrappers are folded from all pages: each task folds its own pages of a host,
   and only these partial wrappers (at most one per host and task) are brought
   together. A wrapper counts the pages that had a slot. Slots of fewer than
   `rare` of the pages so far are forgotten from time to time, by lossy counting
   (Manku and Motwani 2002): none that a template text could stand in is lost,
   since that needs at least `share` of the pages, and the rest stays small.
2. Every page is read once more against its wrapper into blocks (slot, digest,
   text), which are written. Pages of each (host, slot, digest) are counted
   exactly, by partial aggregates, over all pages.
3. The texts that reach the share (as a page has few blocks, a host has few) are
   joined back by host; a host with a third of all pages is split by adaptive
   execution.

Inside an article or main element a text counts as template only if four fifths
of at least `article_pages` pages share it. Text beside such an element is read
too, but only where the host has enough pages to tell that it varies, and lists
of nothing but links there are menus. A page is never emptied because all its
text is shared.

Nulls and odd rows: null or empty html has no text (an empty string); a null
url is a host of its own; text without any tag is one block; repeated rows get
equal results; very long pages are read whole, and deeper than 400 elements the
text hangs on the element there; of equally good alignments the one that pairs
the earlier slots is taken; columns of the user may have any name; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.storage import scratch, table


@dataclass(frozen=True)
class Wrapping:
    """When a slot's text is template: its share of the pages, and the pages it takes to tell."""

    share: float = 0.5
    pages: int = 3
    article_share: float = 0.8
    article_pages: int = 8
    #: Slots that fewer of the pages have are forgotten; far below both shares.
    rare: float = 0.02


# Element names by their part in the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
NO_TEXT = frozenset("head script style noscript template iframe svg object canvas button select textarea input form nav aside footer dialog menu audio video map".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class names. A class name is a role if it is made of these alone, role words among them.
ROLE_WORDS = (
    "nav navbar navigation menu menus footer sidebar aside ad ads advert adverts advertisement advertisements advertising banner sponsor sponsored promo promos promotion "
    "notice notices alert alerts cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription share sharing social breadcrumb breadcrumbs comment comments "
    "commentlist disqus replies search searchbox skip related recommended recommendations toolbar pagination pager login signup copyright disclaimer masthead topbar hidden"
).split()
SIDE_WORDS = (
    "site page main global left right top bottom primary secondary header user reader post article bar box container wrapper wrap list links link menu area section item items inner "
    "outer block widget widgets panel slot unit form posts articles stories buttons button icons icon content text row col column group holder zone reply law"
).split()
ROLE_CLASS = re.compile(rf"(?:(?:{'|'.join(SIDE_WORDS)})[-_]*)*(?:{'|'.join(ROLE_WORDS)})(?:[-_]*(?:{'|'.join([*ROLE_WORDS, *SIDE_WORDS])}|[0-9]+))*")
HEADER_CLASS = re.compile(r"(?:site|page|global|main|top)[-_]?header|header[-_]?(?:bar|top|nav)?")


def names_role(names: str) -> bool:
    """Whether a class or id is a role's: "ad-slot", "reader_comments", "cookieNotice"; not "adventure" or "related-work"."""
    return any(ROLE_CLASS.fullmatch(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", n).lower()) for n in names.split())


#: Open elements that a start tag ends.
ENDS = {
    **dict.fromkeys("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split(), ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",),
}
#: What such an end never reaches beyond.
FENCES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|noscript|template|textarea|iframe|svg|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|$)|"
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(class|id|role|aria-hidden|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)


#: Elements within each other that keep their own nodes.
DEPTH = 400


class Node:
    """An element: its label, what it holds in order (text pieces and nodes), and its part in the page."""

    __slots__ = ("tag", "label", "parts", "drop", "head", "main")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.parts = tag, []
        names = ""
        self.main = tag in ("article", "main")
        self.drop = tag in NO_TEXT
        if attrs and attrs.strip(" /"):
            for m in NAMED.finditer(attrs):
                value = m[2] or m[3] or m[4] or ""
                key = m[1].lower()
                if key == "role":
                    self.main |= value.lower() in ("main", "article")
                    self.drop |= value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu")
                elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                    self.drop = True
                else:
                    names += " " + value
        self.label = tag + (f".{names.split()[0]}" if names.strip() else "")
        if names and tag not in ("body", "html", "main"):
            self.drop |= names_role(names)
        self.head = tag == "header" or bool(names and tag not in ("body", "html", "main", "article") and any(HEADER_CLASS.fullmatch(n.lower()) for n in names.split()))


def parse(html: str) -> Node:
    """A tree of the page; unclosed, misplaced and unknown tags are mended as browsers do, in the main."""
    root = Node("#page")
    stack = [root]
    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            stack[-1].parts.append(html[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("article", "main", "table", "body") and tag in ("p", "b", "i", "a", "span", "li", "em", "strong"):
                    break
            continue
        if tag in ("html", "body") and any(n.tag == tag for n in stack):
            continue
        if tag == "body" and stack[-1].tag == "head":
            stack.pop()
        ended = ENDS.get(tag)
        if ended:
            fence = FENCES.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ended:
                    del stack[i:]
                    break
                if stack[i].tag in fence or (stack[i].tag in BLOCK and stack[i].tag not in ended and tag not in FENCES):
                    break
        node = Node(tag, m[4])
        stack[-1].parts.append(node)
        if tag not in VOID and not m[4].endswith("/"):
            stack.append(node)
        if len(stack) > DEPTH and not node.drop and not any(n.drop for n in stack[DEPTH:-1]):
            stack.pop()  # no deeper: the rest hangs on the last open element; what a role drops is never walked and may be deep
    if at < len(html):
        stack[-1].parts.append(html[at:])
    return root


@dataclass(slots=True)
class Block:
    """A block's text, the labels above it, and whether it lies in an article or main element, or is a link in a list and nothing else."""

    text: str
    path: tuple[str, ...]
    inside: bool
    menu: bool


def blocks(tree: Node) -> list[Block]:
    """The blocks that roles don't drop, in page order. Page headers are dropped, headers of an article or main element aren't."""
    out: list[Block] = []
    pieces: list[str] = []
    linked = 0

    def flush(path: tuple[str, ...], inside: bool, item: bool) -> None:
        nonlocal linked
        text = " ".join(unescape("".join(pieces)).split())
        if text:
            whole = sum(len(p.strip()) for p in pieces)
            out.append(Block(text, path, inside, item and linked >= whole > 0))
        pieces.clear()
        linked = 0

    def walk(node: Node, path: tuple[str, ...], inside: bool, link: bool, item: bool) -> None:
        nonlocal linked
        for p in node.parts:
            if isinstance(p, str):
                pieces.append(p)
                if link:
                    linked += len(p.strip())
                continue
            if p.tag == "br":
                pieces.append(" ")
                continue
            if p.drop or (p.head and not inside):
                if p.tag in BLOCK or p.tag in NO_TEXT:
                    flush(path, inside, item)
                continue
            here = (*path, p.label)
            block = p.tag in BLOCK
            if block:
                flush(path, inside, item)
            within, listed = inside or p.main, item or p.tag == "li"
            walk(p, here, within, link or p.tag == "a", listed)
            if block:
                flush(here, within, listed)

    walk(tree, (), False, False, False)
    flush((), False, False)
    return out


# ---- wrappers --------------------------------------------------------------------


class Slot:
    """A wrapper's node: the pages that had it, its slots in order, and in the root the pages at the last clearing."""

    __slots__ = ("label", "pages", "slots", "missed")

    def __init__(self, label: str):
        self.label, self.pages, self.slots, self.missed = label, 0, [], 0

    def dump(self) -> list:
        return [self.label, self.pages, self.missed, [s.dump() for s in self.slots]]

    @classmethod
    def load(cls, raw: list) -> Slot:
        out = cls(raw[0])
        out.pages, out.missed, out.slots = raw[1], raw[2], [cls.load(x) for x in raw[3]]
        return out


def skeleton(node: Node) -> Slot:
    """A page's own wrapper: siblings of one label are one slot; what roles drop is left out."""
    out = Slot(node.label)
    out.pages = 1
    together: dict[str, list[Node]] = {}
    for p in node.parts:
        if not isinstance(p, str) and not p.drop:
            together.setdefault(p.label, []).append(p)
    for label, alike in together.items():
        if len(alike) > 1:
            whole = Node(alike[0].tag)
            whole.label = label
            whole.parts = [part for p in alike for part in p.parts]
            alike = [whole]
        out.slots.append(skeleton(alike[0]))
    return out


def match(a: Slot, b: Slot, memo: dict) -> int:
    """Simple tree matching: the most pairs of equal labels that keep order and ancestry."""
    if a.label != b.label:
        return 0
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + pairing(a.slots, b.slots, memo)[0]
    return memo[key]


def pairing(xs: list[Slot], ys: list[Slot], memo: dict) -> tuple[int, list[tuple[int, int]]]:
    """The order-keeping pairing of two rows of slots of greatest weight, as indexes."""
    if len(xs) == len(ys) == len({x.label for x in xs}) and all(x.label == y.label for x, y in zip(xs, ys, strict=True)):
        return sum(match(x, y, memo) for x, y in zip(xs, ys, strict=True)), [(i, i) for i in range(len(xs))]
    best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    weight = {}
    for i in range(len(xs) - 1, -1, -1):
        for j in range(len(ys) - 1, -1, -1):
            w = match(xs[i], ys[j], memo)
            weight[i, j] = w
            best[i][j] = max(best[i + 1][j], best[i][j + 1], w + best[i + 1][j + 1] if w else 0)
    pairs, i, j = [], 0, 0
    while i < len(xs) and j < len(ys):
        if weight[i, j] and best[i][j] == weight[i, j] + best[i + 1][j + 1]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return best[0][0], pairs


def merge(into: Slot, other: Slot, memo: dict | None = None) -> None:
    """Aligns other with the wrapper and adds what it has; slots of other that match nothing are put in their place."""
    into.pages += other.pages
    into.missed += other.missed
    memo = {} if memo is None else memo
    _, pairs = pairing(into.slots, other.slots, memo)
    partner = dict((j, i) for i, j in pairs)
    merged, at = [], 0
    for j, s in enumerate(other.slots):
        i = partner.get(j)
        if i is None:
            merged.append(s)
            continue
        merged.extend(into.slots[at:i])
        merge(into.slots[i], s, memo)
        merged.append(into.slots[i])
        at = i + 1
    merged.extend(into.slots[at:])
    into.slots = merged


def clear(wrapper: Slot, rare: float) -> None:
    """Forgets slots that too few of the wrapper's pages can have had; missed bounds the pages of a slot that were forgotten before."""
    bound = rare * wrapper.pages

    def walk(slot: Slot) -> None:
        slot.slots = [s for s in slot.slots if s.pages + wrapper.missed > bound]
        for s in slot.slots:
            walk(s)

    walk(wrapper)
    wrapper.missed = int(bound)


def digest(text: str) -> int:
    import xxhash

    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def numbered(wrapper: Slot) -> dict[int, int]:
    """The wrapper's slots by identity, numbered in page order."""
    out: dict[int, int] = {}

    def walk(slot: Slot) -> None:
        out[id(slot)] = len(out)
        for s in slot.slots:
            walk(s)

    walk(wrapper)
    return out


def aligned(wrapper: Slot, page: Slot) -> dict[tuple[str, ...], Slot]:
    """Path of labels in the page -> the wrapper's slot."""
    out = {(): wrapper}
    memo: dict = {}

    def walk(w: Slot, p: Slot, path: tuple[str, ...]) -> None:
        for i, j in pairing(w.slots, p.slots, memo)[1]:
            here = (*path, p.slots[j].label)
            out[here] = w.slots[i]
            walk(w.slots[i], p.slots[j], here)

    walk(wrapper, page, ())
    return out


def read(html: str | None, wrapper: Slot | None, numbers: dict[int, int]) -> list[tuple[int, int, str, bool, bool]]:
    """(slot, digest, text, inside, menu) of a page's blocks; slot -1 where the wrapper has none."""
    if not html:
        return []
    tree = parse(html)
    found = blocks(tree)
    slots = aligned(wrapper, skeleton(tree)) if wrapper is not None else {}
    return [(numbers.get(id(slots.get(b.path)), -1), digest(b.text), b.text, b.inside, b.menu) for b in found]


def main_text(found: list[tuple[int, int, str, bool, bool]], pages: int, counts: dict[tuple[int, int], int], params: Wrapping = Wrapping()) -> str:
    """The content of a page's blocks, one a line; counts: the pages of its host that hold a text in a slot."""
    article = any(b[3] for b in found)
    if article:
        told = pages >= params.pages
        found = [b for b in found if b[3] or (told and not b[4])]

    def shared(b: tuple[int, int, str, bool, bool]) -> bool:
        least, share = (params.article_pages, params.article_share) if b[3] else (params.pages, params.share)
        return pages >= least and counts.get((b[0], b[1]), 0) >= share * pages

    varying = [b for b in found if not shared(b)]
    own = [b for b in found if b[3]] if article else found
    # Where next to nothing varies, the pages are copies of each other and not fillings of a template.
    if sum(len(b[2]) for b in varying) * 5 >= sum(len(b[2]) for b in own):
        own = varying
    return "\n".join(b[2] for b in own)


def _fold(params: Wrapping):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A partial wrapper for each host of the task."""
        held: dict[str, Slot] = {}
        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                raw = html.as_py()
                if not raw:
                    continue
                own = skeleton(parse(raw))
                if host not in held:
                    held[host] = own
                    continue
                whole = held[host]
                merge(whole, own)
                if whole.pages % max(2, int(1 / params.rare)) == 0:
                    clear(whole, params.rare)
            if len(held) > 20_000:
                yield _wrapper_rows(held)
                held = {}
        if held:
            yield _wrapper_rows(held)

    return run


def _wrapper_rows(held: dict[str, Slot]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([json.dumps(s.dump()) for s in held.values()], pa.string())], ["host", "wrapper"])


def _join(params: Wrapping):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial wrappers come sorted by host."""
        host, whole = None, None
        for batch in batches:
            done: dict[str, Slot] = {}
            for h, raw in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                if h != host:
                    if whole is not None:
                        done[host] = whole
                    host, whole = h, None
                part = Slot.load(json.loads(raw))
                if whole is None:
                    whole = part
                else:
                    merge(whole, part)
                    clear(whole, params.rare)
            if done:
                yield _wrapper_rows(done)
        if whole is not None:
            yield _wrapper_rows({host: whole})

    return run


BLOCKS = "array<struct<slot:int,digest:long,text:string,inside:boolean,menu:boolean>>"


def _read(keys: int):
    kind = pa.list_(pa.struct([("slot", pa.int32()), ("digest", pa.int64()), ("text", pa.string()), ("inside", pa.bool_()), ("menu", pa.bool_())]))
    names = ("slot", "digest", "text", "inside", "menu")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, wrapper, numbers = None, None, {}
        for batch in batches:
            out = []
            for raw, html in zip(batch.column("wrapper"), batch.column("html"), strict=True):
                raw = raw.as_py()
                if raw != last:
                    last, wrapper = raw, Slot.load(json.loads(raw)) if raw else None
                    numbers = numbered(wrapper) if wrapper else {}
                out.append([dict(zip(names, b, strict=True)) for b in read(html.as_py(), wrapper, numbers)])
            yield pa.RecordBatch.from_arrays([*batch.columns[: keys + 1], pa.array(out, kind)], [*batch.schema.names[: keys + 1], "blocks"])

    return run


def _choose(params: Wrapping, keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found, pages, counts in zip(*(batch.column(keys + i) for i in range(3)), strict=True):
                known = {(c["slot"], c["digest"]): c["n"] for c in counts.as_py() or []}
                out.append(main_text([(b["slot"], b["digest"], b["text"], b["inside"], b["menu"]) for b in found.as_py()], pages.as_py() or 0, known, params))
            yield pa.RecordBatch.from_arrays([*batch.columns[:keys], pa.array(out, pa.string())], [*batch.schema.names[:keys], "text"])

    return run


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", params: Wrapping = Wrapping()) -> DataFrame:
    """(host, wrapper): one wrapper for each host, as JSON."""
    rows = pages.select(host_of(url_col).alias("host"), F.col(f"`{html_col}`").alias("html"))
    parts = rows.mapInArrow(_fold(params), "host string, wrapper string")
    return parts.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(_join(params), "host string, wrapper string")


def templates(read_pages: DataFrame, params: Wrapping = Wrapping()) -> DataFrame:
    """(host, pages, counts): the texts of each host that a share of its pages hold in one slot, from pages in blocks."""
    sizes = read_pages.where(F.size("blocks") > 0).groupBy("host").agg(F.count("*").alias("pages"))
    texts = read_pages.select("host", F.explode(F.array_distinct(F.transform("blocks", lambda b: F.struct(b["slot"].alias("slot"), b["digest"].alias("digest"))))).alias("b"))
    counts = texts.where("b.slot >= 0").groupBy("host", "b").agg(F.count("*").alias("n"))
    common = counts.join(sizes, "host").where(F.col("n") >= min(params.share, params.article_share) * F.col("pages"))
    # As many as the blocks of some pages: each of them stands on `share` of the pages.
    lists = common.where(F.col("pages") >= min(params.pages, params.article_pages)).groupBy("host").agg(F.collect_list(F.struct("b.slot", "b.digest", "n")).alias("counts"))
    return sizes.join(lists, "host", "left")


def extract(pages: DataFrame, keep: list[str], url_col: str = "url", html_col: str = "html", params: Wrapping = Wrapping()) -> DataFrame:
    """The columns in keep, with text."""
    found = scratch(wrappers(pages, url_col, html_col, params), "wrappers")
    inner = pages.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], host_of(url_col).alias("host"), F.col(f"`{html_col}`").alias("html"))
    kinds = ", ".join(f"_k{i} {inner.schema[f'_k{i}'].dataType.simpleString()}" for i in range(len(keep)))
    names = [f"_k{i}" for i in range(len(keep))]
    joined = inner.join(found, "host", "left").select(*names, "host", "wrapper", "html")
    read_pages = scratch(joined.mapInArrow(_read(len(keep)), f"{kinds}, host string, blocks {BLOCKS}"), "page-blocks")
    known = scratch(templates(read_pages, params), "templates")
    chosen = read_pages.join(known, "host", "left").select(*names, "blocks", "pages", "counts").mapInArrow(_choose(params, len(keep)), f"{kinds}, text string")
    return chosen.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "text")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, ["page_id", "url"]).withColumn("n_chars", F.char_length("text").cast("long"))
