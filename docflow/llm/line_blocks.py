"""Main text of web pages from the distribution of line blocks.

Markup is stripped into blocks, one line each, in page order. A line weighs as many characters as it
has outside links (inside a marked article, as many as it has); lines of menus, headers, footers, sidebars, notices, adverts, forms and comments
weigh nothing. Weights are summed over sliding windows of lines; where the sums surge from low to
high the text starts, where they dive it ends, and the weighing lines between a surge and its
dive are kept. Where the page marks an article, only its lines weigh, and all of them are kept; so are
all weighing lines of a page without any surge.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

WINDOW = 3
SURGE = 40  # characters in a window, outside marked articles

PARTS = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|select|title|math|object|canvas)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s>/]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
ATTRIBUTES = re.compile(r"([^\s\"'=<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
MARKS = {"class", "id", "role", "aria-label"}

INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr label picture source audio video".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE = set("nav footer aside form menu dialog button head".split())
BOILERPLATE = set(
    "ad ads adv advert advertisement advertising banner sponsor sponsored promo promoted promotion cookie cookies "
    "consent gdpr notice alert popup modal overlay menu nav navbar navigation navigate breadcrumb breadcrumbs sidebar "
    "side aside footer foot header masthead topbar toolbar comment comments disqus reply replies respond share sharing "
    "social related recommended recommendations newsletter subscribe subscription signup login search form widget "
    "pagination pager complementary contentinfo dialog skip copyright".split()
)
# These mark boilerplate as a part of any name; the other words only in names made of such words.
TELLING = set(
    "advert advertisement advertising sponsor sponsored promo cookie cookies consent gdpr popup nav navbar navigation "
    "breadcrumb breadcrumbs sidebar topbar toolbar comments disqus newsletter subscribe signup pagination".split()
)
PLAIN = set(
    "area bar block body bottom box btn button buttons col column container content global group icon icons inner item items left "
    "links list main outer page panel primary right row secondary site slot top unit wrap wrapper".split()
)
KEPT_WHOLE = {"article", "main"}


def _names_boilerplate(name: str) -> bool:
    """Whether a class or another mark names a part that is no text: ``site-footer`` and
    ``post-comments`` do, ``section-header`` and ``related-work`` do not."""
    parts = {x for x in re.split(r"[^a-z]+", name) if len(x) > 1}
    return bool(parts & TELLING) or bool(parts & BOILERPLATE) and parts <= BOILERPLATE | PLAIN


def _boilerplate(tag: str, attributes: str, inside: bool) -> bool:
    if tag in OUTSIDE or tag == "header" and not inside:
        return True
    for name, *values in ATTRIBUTES.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden":
            return True
        names = [value] if name == "aria-label" else value.split()
        if name in MARKS and tag not in ("html", "body", "article", "main") and any(map(_names_boilerplate, names)):
            return True
    return False


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """Text, weight and whether inside a marked article, of every block of the page."""
    out: list[tuple[str, int, bool]] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, boilerplate, article
    linked = link = 0
    bad = inside = False

    def close() -> None:
        nonlocal linked
        joined = " ".join("".join(text).split())
        if joined:
            out.append((joined, 0 if bad else len(joined) if inside else max(0, len(joined) - linked), inside))
        text.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            found = html.unescape(raw)
            text.append(found)
            if link:
                linked += len("".join(found.split()))

    done = 0
    for m in PARTS.finditer(page):
        add(page[done : m.start()])
        done = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            if m[1]:
                text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            link = 0 if m[2] else 1
        if tag in INLINE and not (not m[2] and _boilerplate(tag, m[4], inside)):
            continue
        if tag in VOID:
            if tag == "hr":
                close()
            continue
        if m[2]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if at < 0 and tag in INLINE:
                continue
            close()
            if at >= 0:
                del stack[at:]
        else:
            close()
            if tag in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                stack.pop()
            if not m[4].rstrip().endswith("/"):
                above = stack[-1] if stack else ("", False, False)
                article = above[2] or tag in KEPT_WHOLE
                stack.append((tag, above[1] or _boilerplate(tag, m[4], above[2]), article))
        bad = bool(stack) and stack[-1][1]
        inside = bool(stack) and stack[-1][2]
    add(page[done:])
    close()
    return out


def stretches(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> list[tuple[int, int]]:
    """From each surge of the window sums to the dive that follows, without the weightless lines at
    either end. A line is between them if any window that holds it reaches ``surge``."""
    sums = [sum(weights[max(0, i) : i + window]) for i in range(1 - window, len(weights))]
    out, start = [], None
    for i in range(len(weights) + 1):
        high = i < len(weights) and max(sums[i : i + window]) >= surge
        if high and start is None:
            start = i
        elif not high and start is not None:
            on = [k for k in range(start, i) if weights[k]]
            if on:
                out.append((on[0], on[-1] + 1))
            start = None
    return out


def main_text(page: str | None) -> str:
    lines = lines_of(page or "")
    marked = any(inside and weight for _, weight, inside in lines)
    weights = [w if inside or not marked else 0 for _, w, inside in lines]
    found = (not marked and stretches(weights)) or stretches(weights, surge=1)
    return " ".join(lines[i][0] for a, b in found for i in range(a, b) if weights[i])


def extract_pages(pages: DataFrame, text: str = "html") -> DataFrame:
    """``pages`` with its main text as ``main_text``; all columns and rows stay, ``main_text`` itself
    replaced if there is one. Null, blank and text-free pages give an empty text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(main_text)

    extract = F.pandas_udf(run, "string")
    return pages.withColumn("main_text", extract(F.coalesce(F.col(text), F.lit(""))))


def op2_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    made = extract_pages(table(spark, sf_dir, "pages"))
    return made.select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
