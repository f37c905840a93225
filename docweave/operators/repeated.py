"""Elements whose text comes again on other pages: the candidates for what is chrome and not content."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.sources.parsers import VOID, HtmlRules

#: An identifier of the CSS grammar, without escapes: letters (any but ASCII marks), digits, _ and -, not beginning with a digit.
NAME = re.compile(r"(?:--|-?[^\W\d])[\w-]*")
#: Classes of one element of which all combinations are tried; of more, single ones and all together.
COMBINED = 4


class _Elements(HTMLParser):
    """(own selector, selectors that match it, text) of every element of a page's body outside what is skipped."""

    def __init__(self, skip: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.skip, self.depth = skip, 0
        self.open: list[tuple[str, str, list[str], list[str]]] = []
        self.out: list[tuple[str, list[str], str]] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        if self.depth or tag in self.skip:
            self.depth += 1
            return
        if tag in ("html", "head", "body"):
            return
        said = {k: v or "" for k, v in attrs}
        classes = sorted(c for c in set(said.get("class", "").split()) if NAME.fullmatch(c))
        own_id = said.get("id", "") if NAME.fullmatch(said.get("id", "")) else ""
        above = self.open[-1] if self.open else None
        beneath = [f"{s} > {tag}" for s in above[2]] if above else [f":scope > {tag}"]
        sizes = range(1, len(classes) + 1) if len(classes) <= COMBINED else (1, len(classes))
        matching = [".".join([tag, *some]) for n in sizes for some in combinations(classes, n)] + ([f"{tag}#{own_id}"] if own_id else [])
        path = f"{above[1]} > {tag}" if above else f":scope > {tag}"
        own = ".".join([tag, *classes]) if classes else f"{tag}#{own_id}" if own_id else path
        self.open.append((tag, own, [*matching, *beneath], []))

    def handle_endtag(self, tag):
        if self.depth:
            self.depth -= 1
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.close_to(i)
                return

    def close_to(self, i: int) -> None:
        while len(self.open) > i:
            _, own, matching, text = self.open.pop()
            self.out.append((own, matching, " ".join(" ".join(text).split())))
            if self.open:
                self.open[-1][3].extend(text)

    def handle_data(self, data):
        if not self.depth and self.open:
            self.open[-1][3].append(data)


def _elements(rules: HtmlRules, text_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, own, selectors, texts, digests = [], [], [], [], []
            for i, html in enumerate(batch.column(1).to_pylist()):
                page = _Elements(rules.skip)
                page.feed(html or "")
                page.close()
                page.close_to(0)
                for mine, matching, text in page.out:
                    if text:
                        shown = text if len(text) <= text_chars else text[:text_chars] + " …"
                        rows.append(i)
                        own.append(mine)
                        selectors.append(matching)
                        texts.append(shown)
                        digests.append(hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(own, pa.string()), pa.array(selectors, pa.list_(pa.string())), pa.array(texts, pa.string()), pa.array(digests, pa.string())], ["page", "own", "selectors", "text", "digest"])

    return run


def repeated_elements(pages: DataFrame, page_col: str, html_col: str, text_chars: int = 200, least: int = 2, rules: HtmlRules = HtmlRules()) -> DataFrame:
    """(selector, text, pages, all_pages): texts that a selector finds on `least` pages or more, with the pages it finds anything on.

    A selector is what an element is named by: its tag and classes, else its id,
    else its path from the nearest element that has either. It finds all elements
    that it matches, those with further classes too. Texts are told apart whole and shown up to text_chars.
    """
    kind = pages.schema[page_col].dataType.simpleString()
    rows = pages.select(F.col(page_col).alias("page"), F.col(html_col).cast("string").alias("html"))
    found = rows.mapInArrow(_elements(rules, text_chars), f"page {kind}, own string, selectors array<string>, text string, digest string")
    named = found.select(F.col("own").alias("selector")).distinct()
    hits = found.select("page", F.explode(F.array_distinct(F.array_append("selectors", F.col("own")))).alias("selector"), "text", "digest").distinct()
    hits = hits.join(named, "selector", "left_semi")
    texts = hits.groupBy("selector", "digest").agg(F.min("text").alias("text"), F.countDistinct("page").alias("pages")).where(F.col("pages") >= least)
    reach = hits.groupBy("selector").agg(F.countDistinct("page").alias("all_pages"))
    return texts.join(reach, "selector").select("selector", "text", "pages", "all_pages")
