"""SimHash near-duplicates by segment-popcount embedding (operator 10).

A 64-bit fingerprint is cut into blocks and each block into 2-bit segments; the
vector of segment popcounts is its embedding. A bit flip changes one count by
one, so the Manhattan distance of two embeddings never exceeds the Hamming
distance of the fingerprints. With ``b`` blocks and a limit of ``d`` bits, some
block has a Manhattan distance of at most ``d // b``; ``b`` is chosen so that
this is 0 or 1. The range join on the unit grid therefore meets, for each
block, a fingerprint's own cell and the cells one step up; every candidate is
then verified with the exact Hamming distance.

Only distinct fingerprints are joined, so copies never meet each other. A cell
with more than ``cell_limit`` fingerprints is compared in pairs of sub-cells,
each its own unit of work, and a unit emits a spanning forest of its links, not
all of them. Components come from min-label contraction over the forest edges.

Defined cases: a null or blank text has fingerprint 0, linked like any other;
repeated rows stay rows; a component without any non-null id has a null
component_id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import cut, table

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_CHUNK = 1 << 16


def simhash64(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a text's word shingles (XXH64, seed 42)."""
    words = _WORD.findall(text.encode("utf-8").lower()) if text else []
    n = max(1, len(words) - shingle + 1) if words else 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle]), 42)
                           for i in range(at, min(n, at + _CHUNK))], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per document: id and ``fp`` (long)."""

    @F.pandas_udf("long")
    def fp(text: pd.Series) -> pd.Series:
        return pd.Series([simhash64(t, shingle) for t in text], dtype="int64")

    return docs.select(F.col(id_col).alias("id"), fp(F.col(text_col)).alias("fp"))


def _cells(fps: DataFrame, max_distance: int) -> DataFrame:
    """Grid rows of each fingerprint: (block, cell, probe, fp)."""
    blocks = 2
    while max_distance // blocks > 1:
        blocks *= 2
    bits = 64 // blocks
    mask, odd = (1 << bits) - 1, sum(1 << i for i in range(0, bits, 2))
    rows = []
    for b in range(blocks):
        part = F.shiftrightunsigned(F.col("fp"), b * bits).bitwiseAND(F.lit(mask))
        # the 2-bit field 00, 01, 10 or 11 becomes its popcount 0, 1, 1 or 2
        own = part - F.shiftrightunsigned(part, 1).bitwiseAND(F.lit(odd))
        rows.append((b, own))
    step = max_distance // blocks
    out = [F.struct(F.lit(b).alias("block"), own.alias("cell"), F.lit(0).alias("probe")) for b, own in rows]
    if step:
        for b, own in rows:
            for i in range(0, bits, 2):
                # a segment with count 0 or 1 has a neighbour one step up
                up = F.when(F.shiftrightunsigned(own, i).bitwiseAND(F.lit(3)) < 2, own + F.lit(1 << i))
                out.append(F.when(up.isNotNull(), F.struct(F.lit(b).alias("block"), up.alias("cell"), F.lit(1).alias("probe"))))
    return (fps.select("fp", F.explode(F.filter(F.array(*out), lambda x: x.isNotNull())).alias("g"))
            .select("g.block", "g.cell", "g.probe", "fp"))


def _whole_units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regroups sorted batches so that none ends inside a unit (a unit is bounded)."""
    held = None
    for x in batches:
        x = x if held is None else pd.concat([held, x], ignore_index=True)
        u = x["unit"].to_numpy()
        end = int(np.searchsorted(u, u[-1])) if len(u) else 0
        if end:
            yield x.iloc[:end]
        held = x.iloc[end:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row index of each row's component."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, label):
            break
        label = new
    return label


def _links(max_distance: int, small: int = 24):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in _whole_units(batches):
            unit, kind = x["unit"].to_numpy(), x["kind"].to_numpy()
            fp = x["fp"].to_numpy().astype(np.int64).view(np.uint64)
            n = len(fp)
            starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            sizes = np.diff(np.r_[starts, n])
            size = np.repeat(sizes, sizes)
            pairs: list[tuple[np.ndarray, np.ndarray]] = []

            def met(a, b, kind=kind, fp=fp):
                # kinds: bit 0 probe, bit 1 second sub-cell; probes never meet, two sub-cells meet across only
                split = (kind[a] | kind[b]) & 4
                ok = ((kind[a] & kind[b] & 1) == 0) & ((split == 0) | (((kind[a] ^ kind[b]) & 2) != 0))
                return ok & (np.bitwise_count(fp[a] ^ fp[b]) <= max_distance)

            rows = np.flatnonzero((size > 1) & (size <= small))
            for s in range(1, small):
                rows = rows[rows + s < n]
                rows = rows[unit[rows] == unit[rows + s]]
                if not len(rows):
                    break
                ok = met(rows, rows + s)
                pairs.append((rows[ok], rows[ok] + s))
            for at, m in zip(starts[sizes > small], sizes[sizes > small]):
                for i in range(at, at + m - 1):
                    j = np.arange(i + 1, at + m)
                    ok = met(np.full(len(j), i), j)
                    if ok.any():
                        pairs.append((np.full(int(ok.sum()), i), j[ok]))
            a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
            b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
            label = _forest(n, a, b)
            on = np.flatnonzero(label != np.arange(n))
            signed = fp.view(np.int64)
            yield pd.DataFrame({"a": signed[label[on]], "b": signed[on]})

    return run


def near_links(fps: DataFrame, max_distance: int = 3, cell_limit: int = 1024) -> DataFrame:
    """Forest edges (a, b) that connect exactly the distinct ``fp`` linked at ``max_distance`` bits or fewer."""
    grid = _cells(fps, max_distance)
    full = (grid.groupBy("block", "cell")
            .agg(F.count(F.lit(1)).alias("n"), F.min("probe").alias("only_probes"))
            .filter("n > 1 and only_probes = 0").drop("only_probes"))
    rows = grid.join(full, ["block", "cell"])
    parts = F.ceil(F.col("n") / F.lit(cell_limit)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    rows = (rows.withColumn("parts", parts).withColumn("own", own)
            # sub-cell i of p meets each sub-cell j: unit (min, max)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select(F.xxhash64("block", "cell", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
                    (F.col("probe") + F.when(F.col("own") > F.col("other"), 2).otherwise(0)
                     + F.when(F.col("own") != F.col("other"), 4).otherwise(0)).cast("int").alias("kind"), "fp"))
    return (rows.repartition("unit").sortWithinPartitions("unit")
            .mapInPandas(_links(max_distance), "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); min-label contraction."""
    live = cut(edges.select("a", "b").filter("a != b").distinct())
    done = None
    while not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = cut(both.groupBy("a").agg(F.min("b").alias("p")).select(F.col("a").alias("node"), F.least("a", "p").alias("up")))
        done = up.select("node", F.col("up").alias("root")) if done is None else (
            done.join(up.select(F.col("node").alias("root"), "up"), "root", "left")
            .select(F.col("node"), F.coalesce("up", "root").alias("root")))
        done = cut(done)
        live = cut(live.join(up.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
                   .join(up.select(F.col("node").alias("b"), F.col("up").alias("y")), "b")
                   .filter("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if done is None:
        done = live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return done


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_distance: int = 3, cell_limit: int = 1024) -> DataFrame:
    """One row per document: id, ``fp`` (long), ``component_id`` (smallest id reachable)."""
    marked = cut(fingerprints(docs, id_col, text_col, shingle))
    fps = cut(marked.groupBy("fp").agg(F.min("id").alias("low")))
    comps = components(near_links(fps.select("fp"), max_distance, cell_limit))
    rooted = fps.join(comps, fps.fp == comps.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    found = cut(rooted.join(lows, "root").select("fp", "component_id"))
    return marked.join(found, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def hex64(c):
    return F.lpad(F.lower(F.hex(c)), 16, "0")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs).select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of one document of each group: the smallest id (all rows without id stay)."""
    keep = near_duplicates(docs, id_col, text_col).filter(f"component_id = {id_col}").select(id_col).distinct()
    ids = docs.join(keep, id_col, "left_semi")
    return ids.union(docs.filter(F.col(id_col).isNull())).select(*docs.columns)
