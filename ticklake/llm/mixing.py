"""Mixing sources to target weights by blocks of words (operator 13).

The words of a source, document after document, are packed into blocks of ``block_words`` (the last may be shorter). A target
becomes a number of slots, each of which takes one block. The slots of a source fall on the output shards by a multinomial
draw, made as a binary tree of binomial draws from keyed seeds: any shard's counts and the number of slots before it follow
from the draws on its way from the root, so that every part of every source is drawn by itself, without the others. The
draw is multinomial given each source's total; drawing the totals too would leave sources away from their targets by
the root of their slots. Slot j of a source takes the block at place j modulo n of pass j // n, through a permutation of the source's n
blocks keyed by (seed, source, pass): a Feistel network on the next power of four, walked until it falls inside. A source
is thus used evenly, no block more than ``max_repeats`` times. The last slot of a source takes only the words that its target
still lacks. Slots and blocks meet by a join on (source, block).

Targets: the sources in code point order, null last, have the weights 5, 2, 1, repeating, and share as many words as there
are; a target stops at ``max_repeats`` times its source's words, and the excess goes to the others by weight.

Plan: sizes are summed up by range (``common.running``), so that a source with a third of all rows is many partitions; a
source's slots are drawn in parts of about ``PART_SLOTS``; the join key (source, block) has at most ``max_repeats`` slots and
``block_words`` documents. Targets take one aggregate a round over the table of sources.

Defined cases: a null text has no words, as an empty one; a document without words is taken 0 times; a null source is a
source; rows with null ids come first in their source; rows that repeat are documents of their own; documents of any length
are cut into as many blocks as they touch; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import running, table, written

#: A word, the weights in turn, and how often a source may be repeated.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3

BLOCK_WORDS = 128
#: Blocks of an output shard, on average.
SHARD_SLOTS = 4096
#: Slots that one call draws, on average.
PART_SLOTS = 1 << 18
#: Tasks that draw at most; with more parts than that, a task draws several.
MOST_TASKS = 1 << 15
SEED = 13
_ROUNDS = 4
_EMIT = 1 << 16


def _digest(*parts: object) -> int:
    return int.from_bytes(hashlib.sha256("\x1f".join(map(str, parts)).encode()).digest()[:8], "big")


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser of ``x`` with a key."""
    x = x ^ np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(places: np.ndarray, n: int, *key: object, back: bool = False) -> np.ndarray:
    """Images of ``places`` (each below ``n``) under the permutation of 0..n-1 that ``key`` names, or with ``back`` their origins."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [_digest("round", i, *key) for i in range(_ROUNDS)]
    out = places.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in reversed(keys) if back else keys:
            left, right = (right ^ (_mixed(left, k) & mask), left) if back else (right, left ^ (_mixed(right, k) & mask))
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def needed(target: int, words: int, block_words: int, *key: object) -> tuple[int, int]:
    """(slots, words of the last one) that take ``target`` of a source's ``words``."""
    n = -(-words // block_words)
    turns, rest = divmod(target, words)
    if not rest:
        return turns * n, block_words
    # the last block is the only short one; it matters where this pass has it
    lacks, place = n * block_words - words, int(permuted(np.array([n - 1]), n, *key, turns, back=True)[0])
    k = -(-rest // block_words)
    if place < k and k * block_words - lacks < rest:
        k += 1
    got = k * block_words - (lacks if place < k else 0)
    last = block_words - (lacks if place == k - 1 else 0)
    return turns * n + k, last - (got - rest)


def _left(count: int, lo: int, hi: int, *key: object) -> int:
    """How many of ``count`` slots over the shards lo..hi-1 fall into the first half."""
    mid = (lo + hi) // 2
    return int(np.random.default_rng(_digest("split", lo, hi, *key)).binomial(count, (mid - lo) / (hi - lo))) if count else 0


def drawn(count: int, shards: int, part: int, depth: int, *key: object) -> Iterator[tuple[int, int, int]]:
    """(shard, first slot, slots) of one part of a source: the ``part``-th node at ``depth`` of the tree over the shards."""
    lo, hi, first = 0, shards, 0
    for bit in range(depth - 1, -1, -1):
        if hi - lo < 2:  # a leaf above that depth belongs to its first part
            if part & ((1 << (bit + 1)) - 1):
                return
            break
        left, mid = _left(count, lo, hi, *key), (lo + hi) // 2
        if part >> bit & 1:
            lo, first, count = mid, first + left, count - left
        else:
            hi, count = mid, left
    todo = [(lo, hi, first, count)]
    while todo:
        lo, hi, first, count = todo.pop()
        if not count:
            continue
        if hi - lo == 1:
            yield lo, first, count
            continue
        left, mid = _left(count, lo, hi, *key), (lo + hi) // 2
        todo += [(mid, hi, first + left, count - left), (lo, mid, first, left)]


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources`` (name, source, words) with ``rank``, ``weight`` and ``target``; ``name`` holds no null and orders them."""
    one = sources.withColumn("one", F.lit(1).cast("long")).withColumn("all", F.lit(""))
    ranked = running(one, "all", ["name"], "one", "rank", "n_sources").drop("all", "one", "row", "n_sources")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = written(ranked.withColumn("weight", w).withColumn("most", F.lit(float(max_repeats)) * F.col("words")), "mix-sources")
    # words for each unit of weight; a source whose most is below its share stops there, and the share of the others rises
    share, stopped = 0.0, -1
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(share)
        r = ranked.agg(F.sum("words"), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))).first()
        if r[0] is None or r[2] is None or r[3] == stopped:
            break
        stopped, share = r[3], (r[0] - (r[1] or 0.0)) / r[2]
    return ranked.withColumn("target", F.least("most", F.col("weight") * F.lit(share))).drop("most")


def packed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row for each document: row (an id), id, name, size, start (words before it in its source) and words (of its source)."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    # no null in the key, and null last
    name = F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    return running(docs.select(F.col(id_col).alias("id"), name.alias("name"), size.alias("size")), "name", ["id", "size"], "size", "start", "words")


def pieces(rows: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The part of each document in each block that it touches: row, name, block, at (its place there), lo and hi (words of the document, hi excluded)."""
    b, end = F.lit(block_words), F.col("start") + F.col("size")
    spread = rows.filter("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))))
    at = F.greatest(F.col("start") - F.col("block") * b, F.lit(0))
    return spread.select("row", "name", "block", at.alias("at"), (F.greatest(F.col("block") * b, F.col("start")) - F.col("start")).alias("lo"),
                         (F.least((F.col("block") + 1) * b, end) - F.col("start")).alias("hi"))


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, part_slots: int = PART_SLOTS, seed: int = SEED,
          max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The slots of the mix: shard, name, slot (its number in the source), block, and how many of the block's words it takes at most."""
    key = (seed,)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [needed(min(round(t), w * max_repeats), w, block_words, *key, s) for s, w, t in zip(b["name"], b["words"], b["target"])]
            yield pd.DataFrame({"name": b["name"], "blocks": -(-b["words"] // block_words), "slots": [x[0] for x in found], "last": [x[1] for x in found]})

    of = sources.filter("words > 0").select("name", "words", "target").mapInPandas(count, "name string, blocks long, slots long, last long")
    of = written(of, "mix-counts")
    depth = F.greatest(F.lit(0), F.ceil(F.log2(F.col("slots") / F.lit(float(part_slots))))).cast("int")
    of = of.filter("slots > 0").withColumn("depth", depth)
    total, n_parts = of.agg(F.sum("slots"), F.sum(F.expr("shiftleft(1L, depth)"))).first()
    shards = max(1, -(-int(total or 0) // shard_slots))
    parts = of.withColumn("part", F.explode(F.expr("sequence(0L, shiftleft(1L, depth) - 1)")))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in (r for b in batches for r in b.itertuples()):
            for shard, first, count in drawn(r.slots, shards, r.part, r.depth, seed, r.name):
                for at in range(first, first + count, _EMIT):
                    slot = np.arange(at, min(at + _EMIT, first + count), dtype=np.int64)
                    block = np.empty_like(slot)
                    for turn in np.unique(slot // r.blocks):
                        mine = slot // r.blocks == turn
                        block[mine] = permuted(slot[mine] % r.blocks, r.blocks, *key, r.name, int(turn))
                    words = np.where(slot == r.slots - 1, r.last, block_words)
                    yield pd.DataFrame({"shard": shard, "name": r.name, "slot": slot, "block": block, "words": words})

    # with a number given the parts, a few bytes each, are not coalesced into one task
    return parts.repartition(max(1, min(int(n_parts or 0), MOST_TASKS))).mapInPandas(draw, "shard long, name string, slot long, block long, words long")


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS,
        max_repeats: int = MAX_REPEATS, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, part_slots: int = PART_SLOTS,
        seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, sources, spans). rows: ``packed`` documents. sources: name, words, rank, weight, target.
    spans: the mix, (shard, name, slot, block, row, lo, hi); the words lo..hi-1 of that row stand in that slot of that shard."""
    rows = written(packed(docs, id_col, source_col, text_col), "mix-rows")
    sources = written(targets(rows.groupBy("name").agg(F.max("words").alias("words")), weights, max_repeats), "mix-targets")
    # written, so that both uses of the draws are one
    taken = written(slots(sources, block_words, shard_slots, part_slots, seed, max_repeats), "mix-slots")
    met = taken.join(pieces(rows, block_words), ["name", "block"]).filter("at < words")
    return rows, sources, met.select("shard", "name", "slot", "block", "row", "lo", F.least("hi", F.expr("lo + words - at")).alias("hi"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target of its source and the words that the mix takes of it, from the spans of the whole table's mix."""
    rows, sources, spans = mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    taken = spans.groupBy("row").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    return (rows.join(taken, "row", "left").join(sources.select("name", "target"), "name")
            .select(F.col("id").alias("doc_id"), "size", F.col("words").alias("source_size"), "target", F.coalesce("taken", F.lit(0)).alias("taken")))
