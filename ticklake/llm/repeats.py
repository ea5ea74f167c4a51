"""Repeated byte strings by merging Burrows-Wheeler transforms (operator 7).

Every ``length``-byte string that starts at two places of the corpus is removed
from both. Three steps find these places:

1. Anchors. The smallest hash of the ``GRAM``-byte strings within each window of
   ``length`` bytes marks a place in it. A window that has it in its first half holds
   over half of ``length`` bytes from there on, another one as many up to there: the hash of
   these bytes is the window's anchor, and equal windows have equal anchors. A
   run of windows with one anchor and the bytes they cover is a context. Only
   anchors found at two places or more go on; equal contexts are counted, and
   all windows of a context found twice or more are repeated.
2. Shards. The contexts left over, each found once, and one copy of each of the
   others with the same anchor, are cut from their texts and brought together
   by anchor. Each context is a shard whose rows are its suffixes.
3. Merge. The shards' rows are interleaved by their first ``START`` bytes and the
   interleave is refined: in round h, a row whose follower (the row of the next
   byte, reached by the transform's last-to-first step backwards) has moved in
   round h - 1 is dealt out anew within its block, in the order of the followers.
   Rows whose follower stayed are left alone; no suffix is sorted again. Rows
   first kept apart in round h have a common prefix of h - 1 bytes; rows still
   in one block after ``length`` rounds are a repeated interval.

An anchor with more different contexts than ``group_limit`` is not gathered: its windows
are counted by hash over the whole cluster, which gives the same rows. Equal contexts are counted before
they meet, so that copies, however many, are one context.

Defined cases: a null or empty text has nothing to remove; texts shorter than
``length`` neither; a string that overlaps itself counts; rows that repeat an id
and text count as two places; an empty table gives an empty result; extra
columns are ignored. Texts are UTF-8 bytes; what is left need not be valid UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticklake.llm.common import table, written

GRAM = 16
#: Bytes that the first interleave looks at; nine bits each fit into one number.
START = 7
#: Bytes of contexts merged at once.
_MERGED = 2_000_000
_POSITION = np.uint64((1 << 28) - 1)


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A mixed 64-bit value of the ``GRAM`` bytes at each position."""
    x = raw.astype(np.uint64)
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        x = x[:-step] | (x[step:] << np.uint64(bits))
    h = x[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ (x[8:] + np.uint64(0x7F4A7C159E3779B9)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def contexts(raw: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, end) of the runs of windows with one anchor."""
    n = len(raw) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = _gram_hashes(raw)
    w = length - GRAM + 1
    # hash above, position below: the smallest is the leftmost of equal hashes
    key = (h & ~_POSITION) | (np.arange(len(h), dtype=np.uint64) & _POSITION)
    pad = (-len(key)) % w
    rows = np.r_[key, np.full(pad, np.iinfo(np.uint64).max)].reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:n], ahead[w - 1:w - 1 + n])
    first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    end = np.r_[first[1:], n]
    anchor = (low[first] & _POSITION).astype(np.int64)
    if len(raw) > int(_POSITION):
        anchor = first + ((anchor - first) & int(_POSITION))
    # cut each run where its mark passes from the second half of the window to the first
    half = (length - GRAM) // 2
    cut_ = np.clip(anchor - half, first, end)
    left, right = cut_ > first, end > cut_
    begin = np.r_[first[left], cut_[right]]
    hashes = np.r_[_spanned(h, anchor[left] - half - 1, half + 1 + GRAM, 1), _spanned(h, anchor[right], length - half, 2)]
    order = np.argsort(begin, kind="stable")
    return hashes[order], begin[order], np.r_[cut_[left], end[right]][order]


def _spanned(grams: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place of ``at``, from the hashes of the grams that cover them."""
    out = np.full(len(at), seed, np.uint64)
    for k in (*range(0, size - GRAM, GRAM), size - GRAM):
        out = (out ^ grams[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def _anchors(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for key, t in zip(x["key"], x["text"]):
                body = t.encode("utf-8")
                h, first, end = contexts(np.frombuffer(body, np.uint8), length)
                ctx = [xxhash.xxh3_64_intdigest(body[a:b - 1 + length]) for a, b in zip(first.tolist(), end.tolist())]
                yield pd.DataFrame({"key": key, "anchor": h.view(np.int64), "context": np.array(ctx, np.uint64).view(np.int64),
                                    "first": first.astype(np.int32), "end": end.astype(np.int32)})

    return lambda batches: _joined(run(batches), 200_000)


def _joined(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Small frames put together."""
    held, n = [], 0
    for x in frames:
        held.append(x)
        n += len(x)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key (of id and text; rows with one key have one result) and text."""
    return docs.select(F.xxhash64(F.col(id_col).cast("string"), text_col).alias("key"), F.col(text_col).alias("text"))


def shared_contexts(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(found, kinds). found: every context (key, anchor, context, first, end). kinds: the different ones whose anchor is found
    at two places or more, with ``n``, the places of the whole context, one of them (``c``), and of its anchor the number of
    kinds and of those found once."""
    found = written(rows.filter(F.octet_length("text") >= length).mapInPandas(
        _anchors(length), "key long, anchor long, context long, first int, end int"), "repeats-anchors")
    # equal contexts are one row before anything is dealt out by anchor
    places = found.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first", "end")).alias("c"))
    whole = Window.partitionBy("anchor")
    kinds = (places.withColumns({"m": F.sum("n").over(whole), "kinds": F.count(F.lit(1)).over(whole), "open": F.count_if(F.col("n") == 1).over(whole)})
             .filter("m > 1").drop("m"))
    return found, written(kinds, "repeats-kinds")


def merge_shards(shards: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleaves the shards' suffixes, in order by their first ``length`` bytes.

    For each byte of the shards (joined, with an end mark after each): the block of
    suffixes with equal prefixes it is in (its first row) and that block's size. For
    each row that begins a block: the common prefix with the row before. A suffix
    that ends before ``length`` bytes is a block of its own.
    """
    sizes = np.array([len(x) + 1 for x in shards])
    n = int(sizes.sum())
    word = np.frombuffer(b"\0".join([*shards, b""]), np.uint8).astype(np.uint64) + np.uint64(1)
    ends = np.cumsum(sizes) - 1
    left = np.repeat(ends, sizes) - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(START):
        key = (key << np.uint64(9)) | np.where(left > k, np.r_[word[k:], np.zeros(k, np.uint64)], 0).astype(np.uint64)
    order = np.argsort(key, kind="stable")
    key, alone = key[order], left[order] < START
    begins = np.r_[True, (key[1:] != key[:-1]) | alone[1:] | alone[:-1]]
    prefix = np.full(n, -1, np.int32)
    differ = np.r_[np.uint64(1) << np.uint64(63), key[1:] ^ key[:-1]]
    prefix[begins] = np.minimum(START - np.ceil(np.log2(differ[begins].astype(np.float64) + 1) / 9), START).astype(np.int32)
    starts = np.flatnonzero(begins)
    size = np.zeros(n, np.int64)
    size[starts] = np.diff(np.r_[starts, n])
    block = np.empty(n, np.int64)
    block[order] = np.repeat(starts, size[starts])
    todo = np.flatnonzero(size[block] > 1)
    for h in range(START + 1, length + 1):
        if not len(todo):
            break
        follower = block[todo + 1]
        turn = np.lexsort((follower, block[todo]))
        todo, follower = todo[turn], follower[turn]
        own = block[todo]
        group = np.r_[True, own[1:] != own[:-1]]
        part = group | np.r_[True, follower[1:] != follower[:-1]]
        at, cut_ = np.flatnonzero(group), np.flatnonzero(part)
        dealt = np.diff(np.r_[at, len(todo)])
        # rows whose follower stayed come first in their block
        base = np.repeat(own[at] + size[own[at]] - dealt - at, dealt)
        new = np.repeat(base[cut_] + cut_, np.diff(np.r_[cut_, len(todo)]))
        size[own[at]] -= dealt
        size[new[cut_]] = np.diff(np.r_[cut_, len(todo)])
        moved = new != own
        block[todo] = new
        fresh = cut_[moved[cut_]]
        prefix[new[fresh]] = h - 1
        before = todo[moved] - 1
        before = before[before >= 0]
        before = before[left[before] > 0]
        todo = before[size[block[before]] > 1]
    return block, size[block], prefix


def _merge(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in _whole_anchors(batches):
            shards = list(x["body"])
            _, size, _ = merge_shards(shards, length)
            offset = np.cumsum([0] + [len(b) + 1 for b in shards])
            spans = []
            for i in np.flatnonzero(x["n"].to_numpy() == 1):
                on = np.flatnonzero(np.diff(np.r_[0, size[offset[i]:offset[i + 1] - length] > 1, 0]))
                spans += [(x["key"].iat[i], x["first"].iat[i] + a, x["first"].iat[i] + b) for a, b in zip(on[::2].tolist(), on[1::2].tolist())]
            yield pd.DataFrame(spans, columns=["key", "first", "end"])

    return run


def _whole_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows put together to some megabytes, no anchor cut in two (an anchor's rows are bounded)."""
    held: list[pd.DataFrame] = []
    n = 0
    for x in batches:
        at = 0
        anchor, total = x["anchor"].to_numpy(), np.cumsum([len(b) for b in x["body"]])
        last = np.flatnonzero(np.r_[anchor[1:] != anchor[:-1], False]) + 1
        if held and len(anchor) and held[-1]["anchor"].iat[-1] != anchor[0]:
            last = np.r_[0, last]
        for k in last:
            if n + (total[k - 1] if k else 0) - (total[at - 1] if at else 0) >= _MERGED or not k and n >= _MERGED:
                held.append(x.iloc[at:k])
                yield pd.concat(held, ignore_index=True)
                held, n, at = [], 0, int(k)
        held.append(x.iloc[at:])
        n += int(total[-1] - (total[at - 1] if at else 0)) if len(total) else 0
    if n:
        yield pd.concat(held, ignore_index=True)


def _cut_contexts(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for key, t, wanted in zip(x["key"], x["text"], x["wanted"]):
                body = t.encode("utf-8")
                yield pd.DataFrame([(key, w["anchor"], w["first"], w["n"], w["hot"], body[w["first"]:w["end"] - 1 + length]) for w in wanted],
                                   columns=["key", "anchor", "first", "n", "hot", "body"])

    return lambda batches: _joined(run(batches), 5_000)


def _windows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for key, first, n, body in zip(x["key"], x["first"], x["n"], x["body"]):
                h = [xxhash.xxh3_64_intdigest(body[i:i + length]) for i in range(len(body) - length + 1)]
                yield pd.DataFrame({"key": key, "at": first + np.arange(len(h)), "n": n, "window": np.array(h, np.uint64).view(np.int64)})

    return lambda batches: _joined(run(batches), 50_000)


def repeated_windows(rows: DataFrame, length: int, group_limit: int) -> DataFrame:
    """(key, first, end): runs of windows that start at another place too."""
    found, kinds = shared_contexts(rows, length)
    twice = found.join(kinds.filter("n > 1").select("anchor", "context"), ["anchor", "context"], "left_semi")
    # contexts found once, and one copy of each other one beside them
    wanted = kinds.filter("open > 0").groupBy("c.key").agg(F.collect_list(
        F.struct("anchor", "c.first", "c.end", "n", (F.col("kinds") > group_limit).alias("hot"))).alias("wanted"))
    text = rows.join(wanted.hint("shuffle_hash"), "key")
    bodies = written(text.mapInPandas(_cut_contexts(length), "key long, anchor long, first int, n long, hot boolean, body binary"), "repeats-contexts")
    merged = (bodies.filter("not hot").repartition("anchor").sortWithinPartitions("anchor")
              .mapInPandas(_merge(length), "key long, first int, end int"))
    windows = bodies.filter("hot").mapInPandas(_windows(length), "key long, at int, n long, window long")
    often = windows.groupBy("window").agg(F.count(F.lit(1)).alias("places")).filter("places > 1").select("window")
    single = windows.filter("n = 1").join(often, "window").select("key", F.col("at").alias("first"), (F.col("at") + 1).alias("end"))
    return twice.select("key", "first", "end").unionByName(merged).unionByName(single)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, group_limit: int = 100_000) -> DataFrame:
    """A row for each document: id, bytes, removed runs [first, end) and what is left (binary)."""
    rows = _rows(docs, id_col, text_col)
    runs = (repeated_windows(rows, length, group_limit).groupBy("key")
            .agg(F.collect_list(F.shiftleft(F.col("first").cast("long"), 32) + F.col("end")).alias("runs")))

    @F.pandas_udf("n_bytes long, spans array<array<int>>, kept binary")
    def cut_out(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
        out = []
        for t, r in zip(text, runs):
            body, spans = (t or "").encode("utf-8"), []
            for x in sorted(r) if r is not None else []:
                first, end = int(x) >> 32, (int(x) & 0xFFFFFFFF) - 1 + length
                if spans and first <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([first, end])
            at, kept = 0, []
            for a, b in spans:
                kept.append(body[at:a])
                at = b
            out.append((len(body), spans, b"".join([*kept, body[at:]])))
        return pd.DataFrame(out, columns=["n_bytes", "spans", "kept"])

    keyed = docs.select(F.col(id_col), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("key"))
    joined = keyed.join(runs.hint("shuffle_hash"), "key", "left")
    return joined.select(F.col(id_col), cut_out("text", "runs").alias("x")).select(id_col, "x.n_bytes", "x.spans", "x.kept")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s[1] - s[0]).cast("long"))
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
