"""Language ID: script ranges, then Viterbi over per-word scores (operator 8).

Training counts character trigrams of words by language in every training
document (counted inside the tasks, summed by Spark); the model keeps every
trigram that is ``min_share`` of a language's trigrams or more, at most ``1 / min_share`` of them by that, and the scripts that hold
at least ``min_script_share`` of its words. A word's score for a language is the
log probability of its trigrams, one that was not kept having the same for all languages; a language whose scripts do not include the
word's is no candidate for it. Viterbi with a switching penalty then labels each
word of a text, so that mixed texts split into spans.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; rows that repeat are learned and labelled each;
texts of any length are labelled whole; a
word in a script that no language has scores alike for all; ties go to the
language with the better path score, then to the first by name; an empty
training set makes every document ``und``; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import cut, table

_RUN = re.compile(r"[^\W\d_]+")
#: Distinct words that a task keeps at hand before it turns them into trigrams, or drops their scores.
_REMEMBERED = 300_000

# First code points of script ranges (Unicode blocks) and their script.
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB07, "other"), (0x20000, "han"),
]
_STARTS = [a for a, _ in SCRIPT_RANGES]
SCRIPTS = sorted({s for _, s in SCRIPT_RANGES})
_SCRIPT_OF = np.array([SCRIPTS.index(s) for _, s in SCRIPT_RANGES])


def words_of(text: str) -> list[str]:
    """The runs of letters in ``text``.

    The pattern also takes characters with a numeric value, such as fractions and circled digits, which are no letters: a run that
    holds one is split there. (A pattern that names them all compares each character with hundreds of others.)
    """
    runs = _RUN.findall(text)
    if not runs or "".join(runs).isalpha():
        return runs
    return [w for r in runs for w in ([r] if r.isalpha() else "".join(c if c.isalpha() else " " for c in r).split())]


def _scripts(words: list[str]) -> np.ndarray:
    first = np.fromiter((ord(w[0]) for w in words), np.int64, len(words))
    return _SCRIPT_OF[np.searchsorted(_STARTS, first, side="right") - 1]


@dataclass
class LanguageModel:
    """Languages, trigram rows (the last row is for unseen ones), script masks."""

    langs: list[str]
    rows: dict[str, int]
    logp: np.ndarray
    allowed: np.ndarray
    switch: float

    def __post_init__(self) -> None:
        # words met before and their scores
        self._known: dict[str, int] = {}
        self._scores, self._sizes = np.zeros((0, len(self.langs))), np.zeros(0, np.int64)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(word, language) log scores; a forbidden script costs far more than any switch."""
        get, unseen = self.rows.get, len(self.rows)
        padded = [f"^{w}$" for w in words]
        sizes = np.fromiter((len(w) - 2 for w in padded), np.int64, len(padded))
        idx = np.fromiter((get(w[i:i + 3], unseen) for w in padded for i in range(len(w) - 2)), np.int64, int(sizes.sum()))
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        out = np.empty((len(words), len(self.langs)))
        for j in range(len(self.langs)):
            out[:, j] = np.add.reduceat(self.logp[idx, j], starts)
        ok = self.allowed[_scripts(words)]
        ok[~ok.any(axis=1)] = True
        out = np.where(ok, out, out.min(axis=1, keepdims=True) - 1000.0)
        return out - out.max(axis=1, keepdims=True)

    def paths(self, scores: np.ndarray, docs: list[np.ndarray]) -> list[np.ndarray]:
        """Best language of each word of each document (word numbers into ``scores``)."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(docs)
        order = sorted((i for i in range(len(docs)) if len(docs[i])), key=lambda i: -len(docs[i]))
        k = len(self.langs)
        for at in range(0, len(order), 256):
            group = order[at:at + 256]
            lens = np.array([len(docs[i]) for i in group])
            steps, flat = int(lens[0]), np.concatenate([docs[i] for i in group])
            begin = np.r_[0, np.cumsum(lens)[:-1]]
            # alive[t]: documents with more than t words; they come first
            alive = np.searchsorted(-lens, -np.arange(steps), side="left")
            back = np.empty((int(lens.sum()), k), np.int8)
            best = scores[flat[begin]].copy()
            for t in range(1, steps):
                m = alive[t]
                b = best[:m]
                top = b.argmax(axis=1)
                high = b[np.arange(m), top] - self.switch
                stay = b >= high[:, None]
                back[begin[:m] + t] = np.where(stay, np.arange(k), top[:, None])
                best[:m] = np.where(stay, b, high[:, None]) + scores[flat[begin[:m] + t]]
            state = best.argmax(axis=1)
            path = np.empty(int(lens.sum()), np.int64)
            for t in range(steps - 1, -1, -1):
                m = alive[t]
                path[begin[:m] + t] = state[:m]
                if t:
                    state[:m] = back[begin[:m] + t, state[:m]]
            for j, i in enumerate(group):
                out[i] = path[begin[j]:begin[j] + lens[j]]
        return out

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """(language, share of its letters, spans as (first word, words, language)) of each text."""
        if not self.langs:
            return [("und", 0.0, [])] * len(texts)
        if len(self._known) > _REMEMBERED:
            self._known, self._scores, self._sizes = {}, self._scores[:0], self._sizes[:0]
        ids, before = self._known, len(self._known)
        docs = [np.array([ids.setdefault(w, len(ids)) for w in words_of(t.lower())] if t else [], np.int64) for t in texts]
        if new := list(itertools.islice(ids, before, None)):
            self._scores = np.concatenate([self._scores, self.word_scores(new)])
            self._sizes = np.r_[self._sizes, [len(w) for w in new]]
        scores, size = self._scores, self._sizes
        out = []
        for d, path in zip(docs, self.paths(scores, docs)):
            if not len(d):
                out.append(("und", 0.0, []))
                continue
            letters = np.bincount(path, size[d], len(self.langs))
            total = scores[d].sum(axis=0)
            win = min(range(len(self.langs)), key=lambda j: (-letters[j], -total[j], self.langs[j]))
            cut = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
            spans = [(int(a), int(n), self.langs[path[a]]) for a, n in zip(cut, np.diff(np.r_[cut, len(path)]))]
            out.append((self.langs[win], float(letters[win] / letters.sum()), spans))
        return out


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    grams: dict[str, Counter] = {}
    words: dict[str, Counter] = {}

    def count() -> None:
        for lang, held in words.items():
            own = grams.setdefault(lang, Counter())
            names = list(held)
            for w, s in zip(names, _scripts(names) if names else []):
                n, p = held[w], f"^{w}$"
                own["script " + SCRIPTS[s]] += n
                for i in range(len(p) - 2):
                    own[p[i:i + 3]] += n
        words.clear()

    for x in batches:
        for lang, text in zip(x["lang"], x["text"]):
            words.setdefault(lang, Counter()).update(words_of(text.lower()))
        if sum(map(len, words.values())) > _REMEMBERED:
            count()
    count()
    for lang, c in grams.items():
        yield pd.DataFrame({"lang": lang, "gram": list(c), "n": list(c.values())})


def train(labelled: DataFrame, min_share: float = 2e-6, min_script_share: float = 0.01, switch: float = 12.0) -> LanguageModel:
    """A model from every row of ``labelled`` (text, lang); ``min_share`` bounds its size for each language, whatever the corpus."""
    counts = (labelled.select("lang", "text").dropna().mapInPandas(_count_grams, "lang string, gram string, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    is_script = F.col("gram").startswith("script ")
    counts = cut(counts)
    totals = counts.groupBy("lang", is_script.alias("script")).agg(F.sum("n").alias("total"))
    kept = counts.withColumn("script", is_script).join(totals, ["lang", "script"]).filter(F.col("script") | (F.col("n") >= min_share * F.col("total"))).toPandas()
    langs = sorted(kept["lang"].unique())
    scripts = kept["script"]
    grams = kept[~scripts]
    names = sorted(grams["gram"].unique())
    rows = {g: i for i, g in enumerate(names)}
    n = np.zeros((len(names) + 1, len(langs)))
    n[grams["gram"].map(rows).to_numpy(int), grams["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int)] = grams["n"]
    total = grams.groupby("lang")["total"].first().reindex(langs).to_numpy(float)
    # what is not kept has one share in all languages: half a count of the smallest, or what was cut off
    unseen = max(0.5 / total.min(), min_share / 2) if langs else 1.0
    logp = np.log(n / total + unseen) if langs else n
    allowed = np.zeros((len(SCRIPTS), len(langs)), bool)
    for j, x in enumerate(langs):
        own = kept[scripts & (kept["lang"] == x)]
        for g, c in zip(own["gram"], own["n"]):
            allowed[SCRIPTS.index(g[len("script "):]), j] = c >= min_script_share * own["n"].sum()
    return LanguageModel(langs, rows, logp, allowed, switch)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with ``out``: struct of lang, score and spans (start word, words, lang)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, spans array<struct<start:int,words:int,lang:string>>")
    def label(text: pd.Series) -> pd.DataFrame:
        found = shared.value.label(list(text))
        return pd.DataFrame({"lang": [x[0] for x in found], "score": [x[1] for x in found],
                             "spans": [[{"start": a, "words": n, "lang": g} for a, n, g in x[2]] for x in found]})

    return docs.withColumn(out, label(F.col(text_col)))


def held_out(id_col: str = "doc_id"):
    """The fold that is never learned from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"),
                        F.col("language.score").alias("score"), F.size("language.spans").alias("n_spans"))


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Rows whose text has a language holding ``min_score`` of its letters; columns as given.

    A null text, an empty one and one without a letter go; rows that repeat are judged each; rows without an id are not learned
    from and judged as others; without a labelled row there is no language, and all rows go.
    """
    model = train(docs.filter(F.col("doc_id").isNotNull() & ~held_out()))
    name = next(n for n in ("language", *(f"language{i}" for i in range(len(docs.columns) + 1))) if n not in docs.columns)
    found = identify(docs, model, out=name)
    return found.filter((F.col(f"{name}.lang") != "und") & (F.col(f"{name}.score") >= min_score)).select(*docs.columns)
