"""Benchmark decontamination with a generalised suffix automaton (operator 5).

The normalised words of the test items are put into generalised suffix automata,
one for each block of items (``max_block_words`` words at most, so what is
broadcast and what the driver holds have a fixed bound however many items there
are; blocks are written as a table and streamed one after the other). A document's words stream through an automaton, which
keeps the longest match that ends at each word. A match of ``window`` words, or
of a whole shorter item, is a hit; the hit words form spans, which are cut from
the text. A document whose hit words exceed ``max_coverage`` of its words goes.

Defined cases: a null or blank text has no words and no hits; a null or blank
item has no window; repeated items and rows count as they are, item ids once,
all null ones as one null id;
no items or no documents give results without hits; extra columns are kept.
"""

from __future__ import annotations

import hashlib
import pickle
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticklake.llm.common import table, written

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normalised_words(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8").lower()) if text else []


class SuffixAutomaton:
    """All word sequences that occur in some item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # for the state of a full window: its items; top: that state, above each longer match
        self.items: dict[int, frozenset[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        held: dict[int, set[str]] = {}
        for item, words in items:
            s = 0
            for i, w in enumerate(words):
                s = self.step[s][w]
                if i + 1 >= window:
                    held.setdefault(self._above(s), set()).add(item)
            if 0 < len(words) < window:
                self.short.setdefault(s, []).append((len(words), item))
        self.items = {s: frozenset(x) for s, x in held.items()}
        self.top = [self._above(s) if self.length[s] >= window else -1 for s in range(len(self.step))]
        # items that are shorter than a window and end wherever a match ends in this state
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            if above := self.short.get(self.link[s]):
                self.short[s] = self.short.get(s, []) + above

    def _above(self, s: int) -> int:
        while self.length[self.link[s]] >= self.window:
            s = self.link[s]
        return s

    def _split(self, p: int, q: int, w: bytes) -> int:
        """State of the longest match of ``p`` followed by ``w``, apart from the longer ones of ``q``."""
        c = len(self.step)
        self.step.append(dict(self.step[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = c
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = c
            p = self.link[p]
        return c

    def _extend(self, last: int, w: bytes) -> int:
        q = self.step[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new = len(self.step)
        self.step.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[str], int]:
        """Hit spans [first, end), items hit, longest match."""
        step, link, length, top, short, window = self.step, self.link, self.length, self.top, self.short, self.window
        spans: list[list[int]] = []
        items: set[str] = set()
        s = n = longest = 0
        for i, w in enumerate(words):
            t = step[s].get(w)
            while t is None and s:
                s = link[s]
                n = length[s]
                t = step[s].get(w)
            if t is None:
                continue
            s = t
            n += 1
            if n > longest:
                longest = n
            m = 0
            if n >= window:
                m = window
                items |= self.items[top[s]]
            if s in short:
                for k, item in short[s]:
                    if k <= n:
                        items.add(item)
                        m = max(m, k)
            if m:
                _add(spans, i + 1 - m, i + 1)
        return spans, items, longest


def _add(spans: list[list[int]], first: int, end: int) -> None:
    """Adds a span; spans come in order of their ends and touching ones grow together."""
    while spans and spans[-1][1] >= first:
        first = min(first, spans.pop()[0])
    spans.append([first, end])


def _union(a: list, b: list) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted([[int(x), int(y)] for x, y in a] + b, key=lambda x: x[1]):
        _add(out, first, end)
    return out


def _by_id(item: str | None) -> tuple[bool, str]:
    """Order of item ids; a null one comes last."""
    return item is None, item or ""


def build_blocks(items: DataFrame, id_col: str, text_col: str, window: int, max_block_words: int) -> DataFrame:
    """(block, automaton): pickled automata, built in tasks, one for each block of items."""
    words = F.size(F.split(F.coalesce(F.col(text_col), F.lit("")), r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    total = items.agg(F.sum(words)).first()[0] or 0
    blocks = 1 + total // max_block_words

    def build(x: pd.DataFrame) -> pd.DataFrame:
        rows = [(i if isinstance(i, str) else None, normalised_words(t)) for i, t in zip(x["item"], x["text"])]
        rows.sort(key=lambda r: (_by_id(r[0]), r[1]))
        return pd.DataFrame({"block": [x["block"].iloc[0]], "automaton": [pickle.dumps(SuffixAutomaton(rows, window))]})

    named = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).dropna(subset=["text"])
    named = named.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks).cast("long")))
    return written(named.groupBy("block").applyInPandas(build, "block long, automaton binary"), "decontaminate-items")


_HITS = "n_words long, longest int, items array<string>, spans array<array<int>>"


def _scanner(shared):
    def scan(text: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        automaton = pickle.loads(shared.value)
        rows = []
        for t, longest, items, spans in zip(text, before["longest"], before["items"], before["spans"]):
            words = normalised_words(t)
            s, i, n = automaton.scan(words)
            if items is not None:
                s, i, n = _union(spans, s), i | set(items), max(n, int(longest))
            rows.append((len(words), n, sorted(i, key=_by_id), s))
        return pd.DataFrame(rows, columns=["n_words", "longest", "items", "spans"])

    return scan


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
              window: int = 10, max_block_words: int = 200_000, out: str = "hits") -> DataFrame:
    """``docs`` with ``out``: words, longest match, items hit and hit spans [first word, end)."""
    spark = docs.sparkSession
    found = docs.withColumn(out, F.lit(None).cast(StructType.fromDDL(_HITS)))
    blocks = build_blocks(items, item_id, item_text, window, max_block_words)
    numbers = sorted(r[0] for r in blocks.select("block").collect())
    # one automaton at a time is on the driver; the numbers are few
    for at, number in enumerate(numbers or [None]):
        block = pickle.dumps(SuffixAutomaton([], window)) if number is None else bytes(blocks.filter(F.col("block") == number).first()["automaton"])
        shared = spark.sparkContext.broadcast(block)
        found = found.withColumn(out, F.pandas_udf(_scanner(shared), _HITS)(F.col(text_col), F.col(out)))
        if at + 1 < len(numbers):
            found = written(found, "decontaminate")
            shared.destroy()
    return found


def n_hit(hits: str = "hits"):
    return F.aggregate(F.col(f"{hits}.spans"), F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", max_coverage: float = 0.0, **options) -> DataFrame:
    """``docs`` without the hit spans in their text, and without rows hit in more than ``max_coverage`` of their words."""
    name = next(n for n in ("hits", *(f"hits{i}" for i in range(len(docs.columns) + 1))) if n not in docs.columns)
    found = find_hits(docs, items, text_col, out=name, **options)

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(text, spans):
            if t is not None and len(s):
                raw, low = t.encode("utf-8"), [m.span() for m in _WORD.finditer(t.encode("utf-8").lower())]
                keep, at = [], 0
                for a, b in s:
                    keep.append(raw[at:low[a][0]])
                    at = low[b - 1][1]
                t = b"".join([*keep, raw[at:]]).decode("utf-8")
            out.append(t)
        return pd.Series(out, dtype=object)

    found = found.filter(n_hit(name) <= F.lit(max_coverage) * F.col(f"{name}.n_words"))
    if max_coverage > 0:
        found = found.withColumn(text_col, cut(F.col(text_col), F.col(f"{name}.spans")))
    return found.select(*docs.columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    hits = find_hits(docs, items)
    return (hits.select("doc_id", F.col("hits.n_words").alias("n_words"), n_hit().alias("n_hit"),
                        F.size("hits.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


_WORDS = r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {"op5_decontamination": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS.format(t='text')}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(t='text')} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item, len(g) AS k, array_to_string(g, ' ') AS g FROM (
    SELECT item, unnest([w[i:i + least(10, len(w)) - 1] FOR i IN range(1, greatest(len(w) - 9, 1) + 1)]) AS g FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS g FROM (
    SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)),
m AS (SELECT r, dw.k, p, item FROM dw JOIN win USING (k, g)),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT r, k, p FROM m)) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)"""}
