"""Main text of web pages by line-block distribution (operator 3).

The markup is stripped into lines, one for each block element; menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and styles leave
empty lines. The text lengths of ``window`` lines are summed at each line: the
text begins where this sum surges from nothing and ends where it dives to
nothing. Every such stretch whose highest sum reaches a share of the page's
highest is kept whole. Where ``article`` and ``main`` elements hold half of the text or more, every line
in them counts with its full length and those outside for nothing; else link text counts for nothing.

Defined cases: a null or blank page has the empty text; markup that is cut off
is dropped from where it opens; unclosed elements end with the element around
them; pages that repeat stay; text of any length is kept whole; a form around the page is no part of it; a title that is not
closed ends at the next tag; other columns stay.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import table

# Elements of the HTML standard by their role here.
RAW = frozenset("script style template noscript svg math iframe object title textarea select canvas video audio".split())
BLOCK = frozenset("""p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd article section main table thead tbody tfoot tr caption blockquote pre hr
figure figcaption address details summary fieldset body html header footer nav aside form""".split())
PARTS = frozenset("nav footer aside form menu dialog button head header".split())
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
# Words in class, id or role that name a part which is not the article.
LABELS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side aside menu nav navbar
navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices alert popup modal overlay newsletter subscribe
subscription signup share sharing social related recommended teaser widget comment comments commentlist reply replies disqus discussion
respond pagination pager toolbar search login contentinfo complementary""".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+(?:>|\Z)|</?[a-zA-Z][^>]*+\Z""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")


def _labels(attributes: str) -> set[str]:
    words: set[str] = set()
    for name, *values in _NAMED.findall(attributes):
        if name.lower() == "hidden":
            words.add("popup")
        words.update(re.split(r"[^a-z0-9]+", "".join(values).lower()))
    return words & LABELS


def page_lines(page: str) -> list[tuple[str, int, bool]]:
    """Lines as (text, characters in links, inside article or main); '' for what is stripped."""
    lines: list[tuple[str, int, bool]] = []
    text: list[str] = []
    linked = depth = at = 0
    in_link = False
    seen_article = False
    skip = ""
    nested = 0

    def end_line() -> None:
        nonlocal linked
        joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        if joined:
            lines.append((joined, linked, depth > 0))
        text.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text.append(raw)
        if in_link:
            linked += len(_SPACE.sub(" ", html.unescape(raw)).strip())

    size = len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else size
        if not skip and stop > at:
            add(page[at:stop])
        if not m:
            break
        at = m.end()
        closing, name, rest = m.group(1), m.group(2), m.group(3)
        if name is None:
            closing, name, rest = m.group(4), m.group(5), m.group(6)
        if name is None:
            continue
        name = name.lower()
        if not closing and name in RAW and not rest.endswith("/"):
            at = _raw_end(page, at, name)
            continue
        if skip:
            if not closing and name in ("article", "main") and not seen_article and not _labels(rest):
                skip = ""
            elif name == skip:
                if skip in SELF_CLOSING and not closing:
                    skip = ""
                elif not rest.endswith("/"):
                    nested += -1 if closing else 1
                    if not nested:
                        skip = ""
                        continue
            elif skip in SELF_CLOSING and name in BLOCK:
                skip = ""
            if skip:
                continue
        if name in BLOCK:
            end_line()
        if closing:
            if name in ("article", "main"):
                depth = max(0, depth - 1)
            elif name == "a":
                in_link = False
            continue
        if name in VOID:
            if name == "br":
                add(" ")
            continue
        if name in ("td", "th"):
            add(" ")
        labels = _labels(rest)
        is_part = name in PARTS and not (name == "header" and depth) or (labels and name not in ("html", "body") and not (
            name in ("article", "main") and not labels & {"comment", "comments", "reply", "teaser", "related"}))
        if is_part and name == "form" and not labels and _holds_page(page, at):
            is_part = False
        if is_part and not rest.endswith("/"):
            end_line()
            lines += [("", 0, False)] * 3
            skip, nested = name, 1
        elif name in ("article", "main"):
            depth += 1
            seen_article = True
        elif name == "a":
            in_link = True
    end_line()
    return lines


#: Raw elements that can hold one another.
_NESTED = frozenset("svg math object noscript template".split())


def _raw_end(page: str, at: int, name: str) -> int:
    """Where a raw element ends that was opened before ``at``; a title or text field that is not closed ends with its line."""
    depth, tag = 1, re.compile(f"<(/?){re.escape(name)}\\b[^>]*(?:>|\\Z)", re.I)
    for m in tag.finditer(page, at):
        depth += -1 if m.group(1) else name in _NESTED and not m.group(0).endswith("/>")
        if not depth:
            return m.end()
    if name in ("title", "textarea"):
        line = re.compile(r"[<\n]").search(page, at)
        return line.start() if line else len(page)
    return len(page)


def _holds_page(page: str, at: int) -> bool:
    """Whether a form opened before ``at`` is the frame of a page: it holds an article, or most of the paragraphs."""
    end = re.compile(r"</form\b", re.I).search(page, at)
    inner = page[at:end.start() if end else len(page)]
    if re.search(r"<(?:article|main)\b", inner, re.I):
        return True
    return 2 * len(re.findall(r"<p\b", inner, re.I)) > max(2, len(re.findall(r"<p\b", page, re.I)))


def main_text(page: str | None, window: int = 3, surge_share: float = 0.2) -> str:
    """Blocks of the main text, joined by an empty line."""
    lines = page_lines(page) if page else []
    # an article that holds little of the text is one among others, not the frame of the page
    whole = sum(max(0, len(t) - linked) for t, linked, _ in lines)
    framed = 2 * sum(len(t) for t, _, inside in lines if inside) >= max(1, whole)
    weights = [(len(t) if inside else 0) if framed else max(0, len(t) - linked) for t, linked, inside in lines]
    n = len(lines)
    sums = [sum(weights[i:i + window]) for i in range(n)]
    peak = max(sums, default=0)
    out: list[str] = []
    i = 0
    while i < n:
        if not sums[i]:
            i += 1
            continue
        dive = i
        while dive < n and sums[dive]:
            dive += 1
        surge = next(k for k in range(i, min(n, i + window)) if weights[k]) if any(weights[i:i + window]) else i
        if framed or max(sums[i:dive]) >= surge_share * peak:
            out += [t for (t, _, inside), w in zip(lines[surge:dive], weights[surge:dive]) if t and (w or not framed)]
        i = dive
    return "\n\n".join(out)


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``out``: the main text."""

    @F.pandas_udf("string")
    def text(page: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in page], dtype=object)

    return pages.withColumn(out, text(F.col(html_col)))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
