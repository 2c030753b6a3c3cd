"""Main text of web pages by the distribution of text over blocks of lines.

Markup is stripped so that every block element becomes a line and every menu, advert, form and
the like becomes a run of empty lines. Text lengths, without link text, are summed over sliding
windows of lines. Main text runs from the surge, where the sums rise, to the dive, where they
fall back to nothing.
"""

from __future__ import annotations

import html as characters
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranktrail.llm.common import pages

WINDOW = 3
SURGE = 86  # characters in a window of lines; 1 inside a declared article

# Element names by their role in the HTML standard.
HIDDEN = ("script", "style", "noscript", "template", "title", "textarea", "svg", "iframe", "object")
FURNITURE = (
    "nav header footer aside form menu dialog button select option fieldset head".split()
)
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "meter output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = "area base br col embed hr img input link meta param source track wbr".split()
DECLARED = ("article", "main")
# Words in class, id and role that name page furniture.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|aside"
    r"|ads?|advert|adverts|advertisement|advertising|adsense|sponsor|sponsored|promo|banner"
    r"|cookies?|consent|notice|notices|alert|popup|modal|newsletter|subscribe|signup|login|search"
    r"|comments?|disqus|replies|respond|share|sharing|social|related|recommended"
    r"|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<hidden>" + "|".join(HIDDEN) + r")\b[^>]*>.*?(?:</(?P=hidden)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|(?=<)|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.I | re.S,
)
_LABEL = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)


@dataclass
class Line:
    text: str
    weight: int  # visible characters outside links
    declared: bool  # inside an article or main element
    home: int  # number of the innermost container element


def _is_furniture(name: str, rest: str) -> bool:
    if name in FURNITURE:
        return True
    if not rest or name in ("html", "body", *DECLARED):
        return False
    labels = (a or b or c for a, b, c in _LABEL.findall(rest))
    return any(NAMES.search(label) for label in labels) or bool(_UNSEEN.search(rest))


def lines_of(page: str) -> list[Line]:
    """Block elements as lines; stripped regions as WINDOW empty lines."""
    lines: list[Line] = []
    parts: list[str] = []
    linked = 0
    stack: list[str] = []  # open elements that are not void
    homes = [0]  # numbers of the containers among them
    skip = declared = link = opened = 0  # skip and link: stack height where it began, 0 for none

    def text(segment: str) -> None:
        nonlocal linked
        if not skip and segment:
            parts.append(segment)
            if link:
                linked += len("".join(characters.unescape(segment).split()))

    def end_line() -> None:
        nonlocal parts, linked
        if parts:
            words = " ".join(characters.unescape("".join(parts)).split())
            if words:
                solid = len(words) - words.count(" ")
                lines.append(Line(words, max(0, solid - linked), declared > 0, homes[-1]))
        parts, linked = [], 0

    at = 0
    for token in _TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name not in INLINE:
            end_line()
        elif name in ("br", "img", "wbr"):
            text(" " if name == "br" else "")
        if token["close"]:
            if name in stack:
                while True:
                    closed = stack.pop()
                    declared -= closed in DECLARED
                    if closed != "p" and closed not in INLINE:
                        homes.pop()
                    if skip > len(stack):
                        skip = 0
                    if link > len(stack):
                        link = 0
                    if closed == name:
                        break
        elif name not in VOID and not token["rest"].endswith("/"):
            if name == "p" and stack and stack[-1] == "p":
                stack.pop()
                skip = skip if skip <= len(stack) else 0
            stack.append(name)
            if name != "p" and name not in INLINE:
                opened += 1
                homes.append(opened)
            if name in DECLARED:
                declared += 1
                skip = 0  # furniture that was never closed ends where an article begins
            elif not skip and name not in INLINE and _is_furniture(name, token["rest"]):
                end_line()
                lines.extend(Line("", 0, declared > 0, -1) for _ in range(WINDOW))
                skip = len(stack)
            elif name == "a" and not link:
                link = len(stack)
    text(page[at:])
    end_line()
    return lines


def runs_of(weights: list[int], window: int, surge: int) -> list[tuple[int, int]]:
    """Line ranges from surge to dive whose windows reach the surge at least once.

    The sum of a window belongs to its first line. A range begins at the first line with text of
    its own after empty windows and ends before a window without any.
    """
    n, total = len(weights), sum(weights[:window])
    sums = []
    for i in range(n):
        sums.append(total)
        total += (weights[i + window] if i + window < n else 0) - weights[i]
    found, i = [], 0
    while i < n:
        if not sums[i]:
            i += 1
            continue
        start = next(j for j in range(i, n) if weights[j])
        dive = next((j for j in range(start, n) if not sums[j]), n)
        if max(sums[start:dive]) >= surge:
            last = max(j for j in range(start, dive) if weights[j])
            found.append((start, last + 1))
        i = dive + 1
    return found


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """Lines between surges and dives, one per block, joined by line feeds.

    In a page that declares an article or a main part, only its lines have weight, and any text
    there is a surge. Elsewhere ranges that reach it bring those of their containers with them, and
    the richest range stands for the text if none reaches it.
    """
    lines = lines_of(page or "")
    if any(x.declared and x.text for x in lines):
        lines = [x if x.declared else Line("", 0, False, -1) for x in lines]
        runs = runs_of([len(x.text) for x in lines], window, 1)
    else:
        weights = [x.weight for x in lines]
        runs = runs_of(weights, window, surge)
        if runs:  # what an advert cuts off from a range in the same container belongs to it
            homes = {x.home for a, b in runs for x in lines[a:b] if x.text}
            every = runs_of(weights, window, 1)
            runs = [(a, b) for a, b in every if homes & {x.home for x in lines[a:b] if x.text}]
        else:
            runs = runs_of(weights, window, 1)
            runs = sorted(runs, key=lambda r: (-sum(weights[r[0] : r[1]]), r))[:1]
    return "\n".join(x.text for a, b in runs for x in lines[a:b] if x.text)


def extract_main_text(docs: DataFrame, window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """Columns of the pages with ``text``, empty if a page has none, and its ``n_chars``.

    Null html counts as empty. Repeated rows are extracted each; columns named like results are
    replaced. An empty table gives no rows.
    """

    @F.pandas_udf("string")
    def extract(html: pd.Series) -> pd.Series:
        return html.map(lambda page: main_text(page, window, surge), na_action=None)

    texts = docs.withColumn("text", extract(F.col("html")))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(pages(spark, sf_dir)).select("page_id", "url", "text", "n_chars")
