"""Learned decision lists for document quality, on built-in expressions (operator 6).

Statistics of every text are computed in place with array functions. From the
labelled documents a decision list is learned by sequential covering: a rule
grows by the threshold condition with the highest information gain over the
growing part of the rows, is pruned on the other part, and the rows it covers
leave before the next rule is learned. Thresholds are quantiles over the rows
left and over the bad ones among them; the chosen one is moved between its
neighbours until no value lies between. Each step is one Spark aggregate over the
labelled rows (counts by statistic and bin); only those counts, bounded by
statistics times bins, reach the driver. The list is emitted as one ordered
conditional expression.

Defined cases: a null text has no words and fails the base rules; documents
without a label are judged but never learned from, a label without a document is
ignored, a document with several labels counts with each; no labels give an
empty list, which keeps what passes the base rules; ties go to the first
statistic and the lowest bin; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import cut, table

_SPACE = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"


def _repeat_words(hashes: str) -> Column:
    """Words in windows (by hash, in order) that occur twice or more."""
    order = F.array_sort(F.transform(F.col(hashes), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    last = F.size(hashes) - 1
    same = lambda s, i, j: F.coalesce(F.get(s, j)["h"] == F.get(s, i)["h"], F.lit(False))
    return F.transform(F.array(order), lambda s: F.transform(
        F.array(F.array_sort(F.transform(F.filter(F.sequence(F.lit(0), last), lambda i: same(s, i, i - 1) | same(s, i, i + 1)),
                                         lambda i: F.get(s, i)["i"]))),
        lambda p: F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(5)), F.lit(5))),
                              F.lit(0).cast("long"), lambda n, x: n + x))[0])[0]


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, counts, and the ratios that rules are learned on."""
    t = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("words", F.filter(F.split(t, _SPACE), lambda w: w != ""))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    window = lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(5)])
    rows = rows.withColumn("windows", F.when(F.col("n_words") >= 5, F.transform(F.sequence(F.lit(0), F.size("words") - 5), window))
                           .otherwise(F.array().cast("array<bigint>")))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    bare = F.regexp_replace(t, _SPACE, "")
    rows = rows.select(
        "doc_id", "n_words", F.length(bare).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))[0].alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) == F.size("windows"), F.lit(0).cast("long")).otherwise(_repeat_words("windows")).alias("n_repeat_words"),
        F.size(F.array_distinct("words")).alias("n_distinct"), (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", ""))).alias("n_upper"),
        (F.length(t) - F.length(F.translate(t, "0123456789", ""))).alias("n_digits"), (F.length(t) - F.length(F.translate(t, "!?", ""))).alias("n_marks"))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return (rows.withColumn("word_length", share("word_chars", "n_words")).withColumn("symbol_share", share("n_symbols", "n_words"))
            .withColumn("repeat_share", share("n_repeat_words", "n_words")).withColumn("distinct_share", share("n_distinct", "n_words"))
            .withColumn("upper_share", share("n_upper", "word_chars")).withColumn("digit_share", share("n_digits", "word_chars"))
            .withColumn("mark_share", share("n_marks", "n_words")))


STATISTICS = ["n_words", "word_length", "symbol_share", "n_dup_lines", "repeat_share", "distinct_share", "upper_share", "digit_share", "mark_share"]


@dataclass(frozen=True)
class Condition:
    """``statistic <= threshold``, or ``>`` if ``above``."""

    statistic: str
    threshold: float
    above: bool

    def column(self) -> Column:
        c, x = F.col(self.statistic), F.lit(self.threshold)
        return c > x if self.above else c <= x


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out


def decide(rules: list[Rule]) -> Column:
    """Number of the first rule that holds, from 1; 0 if none does."""
    out = None
    for i, rule in enumerate(rules):
        out = (F.when if out is None else out.when)(rule.column(), F.lit(i + 1))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def _bin(statistic: str, thresholds: list[float]) -> Column:
    """How many of the thresholds lie below the value."""
    return F.size(F.filter(F.array(*[F.lit(float(x)) for x in thresholds]), lambda x: F.col(statistic) > x))


def _quantiles(rows: DataFrame, values: dict[str, Column], bins: int) -> dict[str, list[float]]:
    """Distinct quantiles of each of ``values`` over the rows."""
    found = rows.agg(*[F.percentile_approx(v, [i / bins for i in range(1, bins)], 10_000).alias(k) for k, v in values.items()]).first()
    return {k: sorted(set(found[k] or [])) for k in values}


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """Quantiles of each statistic over all rows and over the bad ones."""
    cuts = _quantiles(rows, {**{f"all {s}": F.col(s) for s in STATISTICS}, **{f"bad {s}": F.when(F.col("bad") == 1, F.col(s)) for s in STATISTICS}}, bins)
    return {s: sorted({*cuts[f"all {s}"], *cuts[f"bad {s}"]}) for s in STATISTICS}


def _best(covered: DataFrame, thresholds: dict[str, list[float]], barred: set[tuple[str, bool]]) -> Condition | None:
    """The condition with the highest gain, none of a ``barred`` (statistic, above)."""
    names = [s for s in STATISTICS if thresholds.get(s)]
    if not names:
        return None
    bins = F.array(*[F.struct(F.lit(i).alias("s"), _bin(s, thresholds[s]).alias("bin")) for i, s in enumerate(names)])
    counts = covered.select("bad", F.explode(bins).alias("b")).groupBy("b.s", "b.bin").agg(
        F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()
    p0 = sum(r["p"] for r in counts if r["s"] == 0)
    n0 = sum(r["n"] for r in counts if r["s"] == 0)
    if not p0 or not n0:
        return None
    best, gain = None, 0.0
    for i, s in enumerate(names):
        held = {r["bin"]: (r["p"], r["n"]) for r in counts if r["s"] == i}
        low_p = low_n = 0
        for b, x in enumerate(thresholds[s]):
            p, n = held.get(b, (0, 0))
            low_p, low_n = low_p + p, low_n + n
            for above, pp, nn in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                if pp and (s, above) not in barred:
                    g = pp * (math.log2(pp / (pp + nn)) - math.log2(p0 / (p0 + n0)))
                    if g > gain + 1e-9:
                        best, gain = Condition(s, x, above), g
    return best


def _refined(covered: DataFrame, best: Condition, thresholds: list[float], bins: int) -> Condition:
    """``best`` with its threshold moved between its neighbours, until no value lies between."""
    s, known = best.statistic, thresholds
    while True:
        at = known.index(best.threshold)
        low, high = known[at - 1] if at else -math.inf, known[at + 1] if at + 1 < len(known) else math.inf
        between = covered.filter((F.col(s) > low) & (F.col(s) < high) & (F.col(s) != best.threshold))
        new = _quantiles(between, {s: F.col(s)}, bins)[s]
        if not new:
            return best
        known = sorted({*new, best.threshold, *(x for x in (low, high) if math.isfinite(x))})
        best = _best(covered, {s: known}, {(s, not best.above)}) or best


def _grow(rows: DataFrame, thresholds: dict[str, list[float]], bins: int, max_conditions: int | None, barred: set[tuple[str, bool]]) -> list[Condition]:
    """Conditions of a rule, the first none of ``barred``; each leaves fewer rows, until none gains."""
    conditions: list[Condition] = []
    while max_conditions is None or len(conditions) < max_conditions:
        covered = rows.filter(F.col("growing") & Rule(tuple(conditions)).column())
        best = _best(covered, thresholds, set() if conditions else barred)
        if best is None:
            break
        conditions.append(_refined(covered, best, thresholds[best.statistic], bins))
    return conditions


def learn(labelled: DataFrame, bins: int = 32, max_rules: int | None = None, max_conditions: int | None = None,
          min_precision: float = 0.9, min_covered: int = 5) -> list[Rule]:
    """An ordered list of rules for ``bad`` = 1. ``labelled``: doc_id, bad (0 or 1) and STATISTICS.

    Every labelled row is used. A rule that covers too little or is too often wrong
    is followed by the best one with another first condition; the list ends when
    none of these passes. ``max_rules`` and ``max_conditions`` bound it only if given.
    """
    rows = cut(labelled.withColumn("growing", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 > 0, F.lit(True))))
    rules: list[Rule] = []
    while max_rules is None or len(rules) < max_rules:
        # with fewer bad rows left no rule can pass
        if (rows.agg(F.sum("bad")).first()[0] or 0) < max(1, min_precision * min_covered):
            break
        thresholds, barred, rule = _thresholds(rows, bins), set(), None
        while rule is None and (grown := _grow(rows, thresholds, bins, max_conditions, barred)):
            rule = _pruned(rows, grown, min_precision, min_covered)
            barred.add((grown[0].statistic, grown[0].above))
        if rule is None:
            break
        rules.append(rule)
        rows = rows.filter(~rule.column())
    return rules


def _pruned(rows: DataFrame, grown: list[Condition], min_precision: float, min_covered: int) -> Rule | None:
    """The head of ``grown`` that does best on the other part of the rows, of those that pass on all."""
    heads = [Rule(tuple(grown[:k])) for k in range(1, len(grown) + 1)]
    got = rows.agg(*[F.sum(F.when(r.column() & part, x)).alias(f"{name}{k}") for k, r in enumerate(heads)
                     for name, part, x in (("p", ~F.col("growing"), F.col("bad")), ("n", ~F.col("growing"), 1 - F.col("bad")),
                                           ("a", F.lit(True), F.col("bad")), ("b", F.lit(True), 1 - F.col("bad")))]).first()
    number = lambda name, k: got[f"{name}{k}"] or 0
    value = lambda k: (number("p", k) - number("n", k)) / max(1, number("p", k) + number("n", k))
    covers = lambda k: number("a", k) + number("b", k)
    passing = [k for k in range(len(heads)) if covers(k) >= min_covered and number("a", k) >= min_precision * covers(k)]
    return heads[max(passing, key=lambda k: (value(k), -k))] if passing else None


def judge(statistics: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``statistics`` with base_failed, rule (0: none holds) and kept; ``labels``: doc_id, quality (1: good)."""
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = statistics.withColumn("base_failed", base)
    known = labels.select("doc_id", (1 - F.col("quality")).cast("int").alias("bad")).dropna()
    rules = learn(rows.filter(~F.col("base_failed")).join(known, "doc_id").select("doc_id", "bad", *STATISTICS), **options)
    rows = rows.withColumn("rule", decide(rules))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    statistics = cut(text_statistics(table(spark, sf_dir, "documents", "doc_id", "text")))
    rows = judge(statistics, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
