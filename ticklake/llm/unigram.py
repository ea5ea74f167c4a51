"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie (operator 4).

A text is escaped (a space becomes U+2581, one is put in front) and cut before
each run of markers; no piece may cross such a cut, so each part is segmented
for itself and equal parts of a batch only once. All parts of a batch walk the
double-array trie at the same time, byte by byte, and the Viterbi recursion runs
over them in step. A character that no piece covers becomes byte pieces.

Scores. A unigram vocabulary holds log probabilities, used as they are. The
pieces of a BPE vocabulary hold minus their merge rank; ``scores="zipf"`` turns
a rank r into the log probability -log(r + 1) - log(H), Zipf's law over the
ranks. ``scores="file"`` uses the file's numbers.

Decoding joins the pieces, turns markers into spaces and drops the first space;
byte pieces are gathered into UTF-8. A marker character in the text itself is
encoded as bytes, so that every text comes back exactly.

Defined cases: a null text has null ids and a null decoding; an empty text has
no ids; ties go to the longer last piece first met; texts of any length are
encoded whole; rows that repeat and extra columns stay as they are.
"""

from __future__ import annotations

import itertools
import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import table

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Below the lowest score, for a character that no piece covers (a fixed value of the format).
UNKNOWN_PENALTY = 10.0
_PART = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Stands for a marker in the text itself; no character, so no piece has this byte.
_LITERAL = b"\xff"
#: A code point that no valid text holds.
_ESCAPED = "\udfff"
_IN_STEP = 64
#: Bytes of a longer part whose edges are held at a time.
_WINDOW = 1 << 16
#: Characters of parts whose ids a task keeps at hand; beyond it they are dropped and found anew.
_REMEMBERED = 1_000_000
#: Text whose ids and decodings a task holds at a time.
_SLICE_BYTES = 1_000_000


@dataclass
class DoubleArray:
    """``child = base[s] + byte + 1`` if ``check[child] == s``; ``value`` is the piece id or -1."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, keys: dict[bytes, int]) -> DoubleArray:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for key, v in sorted(keys.items()):
            s = 0
            for c in key:
                if c not in children[s]:
                    children[s][c] = len(children)
                    children.append({})
                    ends.append(-1)
                s = children[s][c]
            ends[s] = v
        room = len(children) * 2 + 512
        base, check, value = np.zeros(room, np.int32), np.full(room, -1, np.int32), np.full(room, -1, np.int32)
        used = bytearray(room)
        used[0] = 1
        # a lone child takes the first free slot; several look for room from ``wide`` on, which moves past dense parts
        free, wide, todo = 257, 257, [(0, 0)]
        while todo:
            node, slot = todo.pop()
            value[slot] = ends[node]
            codes = sorted(children[node])
            if not codes:
                continue
            while used[free]:
                free += 1
            first = at = (free if len(codes) == 1 else max(free, wide)) - codes[0] - 1
            while any(used[at + c + 1] for c in codes):
                at += 1
                if at + 258 >= len(used):
                    used.extend(bytes(len(used)))
                    base, check, value = (np.r_[x, np.full(len(x), f, np.int32)] for x, f in ((base, 0), (check, -1), (value, -1)))
            if at - first > 64:
                wide = at
            while max(at, free) + 258 >= len(used):
                used.extend(bytes(len(used)))
                base, check, value = (np.r_[x, np.full(len(x), f, np.int32)] for x, f in ((base, 0), (check, -1), (value, -1)))
            base[slot] = at
            for c in codes:
                used[at + c + 1] = 1
                check[at + c + 1] = slot
                todo.append((children[node][c], at + c + 1))
        last = int(np.flatnonzero(np.frombuffer(bytes(used), np.uint8))[-1]) + 258
        grow = lambda x, f: np.r_[x, np.full(max(0, last - len(x)), f, np.int32)][:last]
        return cls(grow(base, 0), grow(check, -1), grow(value, -1))

    def matches(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (start, end, piece) that begin at ``starts`` and stop by ``ends``."""
        out, state, at, stop = [], np.zeros(len(starts), np.int32), starts.copy(), ends
        begin = starts
        while len(at):
            child = self.base[state] + text[at] + 1
            ok = self.check[child] == state
            state, begin, at, stop = child[ok], begin[ok], at[ok] + 1, stop[ok]
            v = self.value[state]
            hit = v >= 0
            out.append((begin[hit], at[hit], v[hit]))
            more = at < stop
            state, begin, at, stop = state[more], begin[more], at[more], stop[more]
        return tuple(np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in range(3))


class UnigramModel:
    """Pieces with log scores; ``byte_ids[b]`` is the piece of byte ``b``."""

    def __init__(self, pieces: Iterable[tuple[str, float]], ids: Iterable[int], byte_ids: list[int], unknown_id: int) -> None:
        named = dict(zip(ids, pieces))
        if bad := next((p for p, _ in named.values() if MARK in p.lstrip(MARK)), None):
            raise ValueError(f"piece {bad!r} has a marker after other characters")
        size = max([*named, *byte_ids, unknown_id]) + 1
        self.text: list[str] = [""] * size
        self.score = np.zeros(size)
        for i, (p, s) in named.items():
            self.text[i], self.score[i] = p, s
        self.byte_ids, self.unknown_id = np.array(byte_ids, np.int32), unknown_id
        self.byte_of = {i: b for b, i in enumerate(byte_ids)}
        self.unknown = (min(s for _, s in named.values()) if named else 0.0) - UNKNOWN_PENALTY
        self.trie = DoubleArray.build({p.encode("utf-8"): i for i, (p, _) in named.items() if p})
        self._bytes = [t.replace(MARK, " ").encode("utf-8") for t in self.text]
        for i, x in self.byte_of.items():
            self._bytes[i] = bytes((x,))
        self._forget()

    @classmethod
    def load(cls, path: str = DEFAULT_MODEL, scores: str = "zipf") -> UnigramModel:
        """Pieces of a SentencePiece model file."""
        import sentencepiece

        if scores not in ("zipf", "file"):
            raise ValueError("scores must be 'zipf' or 'file'")
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        byte_ids = {m.id_to_piece(i): i for i in range(n) if m.is_byte(i)}
        plain = [i for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        value = np.array([m.get_score(i) for i in plain])
        if scores == "zipf":
            rank = np.argsort(np.argsort(-value, kind="stable"), kind="stable") + 1.0
            value = -np.log(rank + 1) - np.log(np.sum(1 / (rank + 1)))
        if byte_ids and len(byte_ids) != 256:
            raise ValueError("a vocabulary with byte pieces must have all 256")
        return cls([(m.id_to_piece(i), float(s)) for i, s in zip(plain, value)], plain,
                   [byte_ids[f"<0x{b:02X}>"] for b in range(256)] if byte_ids else [], m.unk_id())

    def encode(self, texts: list[str | None]) -> list[list[int] | None]:
        return [None if x is None else x.tolist() for x in self.encode_arrays(texts)]

    def encode_arrays(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Piece ids of each text. Parts met before are looked up, as long as ``_REMEMBERED`` characters allow."""
        if self._held > _REMEMBERED:
            self._forget()
        known, docs = self._known, []
        before = len(known)
        for t in texts:
            t = f" {t}".replace(MARK, _ESCAPED).replace(" ", MARK) if t else ""
            docs.append(np.array([known.setdefault(p, len(known)) for p in _PART.findall(t)], np.int64))
        new = list(itertools.islice(known, before, None))
        self._held += sum(map(len, new))
        mark = _ESCAPED.encode("utf-8", "surrogatepass")
        # the stand-in for a literal marker becomes one byte that no piece holds
        self._segment([p.encode("utf-8", "surrogatepass").replace(mark, _LITERAL) for p in new])
        out = []
        for t, d in zip(texts, docs):
            size = self._ends[d] - self._begins[d]
            at = np.cumsum(size) - size
            out.append(None if t is None else self._ids[np.repeat(self._begins[d] - at, size) + np.arange(int(size.sum()))])
        return out

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids, self._begins, self._ends, self._held = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _segment(self, parts: list[bytes]) -> None:
        """Adds the ids of new parts to those known."""
        # short parts in step, some thousands at a time; long ones one by one
        order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
        at, found, sizes = 0, [self._ids], []
        while at < len(order):
            end = at + 1
            size = len(parts[order[at]])
            while end < len(order) and end - at < 20_000 and len(parts[order[end]]) <= _IN_STEP and size < 250_000:
                size += len(parts[order[end]])
                end += 1
            ids, count = self._long(parts[order[at]]) if size > _IN_STEP and end == at + 1 else self._viterbi([parts[i] for i in order[at:end]])
            found.append(ids)
            sizes.append(count)
            at = end
        ends = len(self._ids) + np.cumsum(np.concatenate(sizes)) if sizes else np.zeros(0, np.int64)
        begins = ends - np.concatenate(sizes) if sizes else ends
        back = np.argsort(order) if order else np.zeros(0, np.int64)
        self._begins, self._ends = np.r_[self._begins, begins[back]], np.r_[self._ends, ends[back]]
        self._ids = np.concatenate(found)

    def _viterbi(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts, one part after the other, and how many each has."""
        raw = np.frombuffer(b"".join(parts), np.uint8).astype(np.int32)
        lens = np.array([len(p) for p in parts])
        ends = np.cumsum(lens)
        begins, n = ends - lens, len(raw)
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        part = np.searchsorted(ends, lead, side="right")
        a, b, piece = self.trie.matches(raw, lead, ends[part])
        # a lone character without a piece of its own is unknown
        width = np.diff(np.r_[lead, n])
        covered = np.zeros(n + 1, bool)
        covered[a[b - a == width[np.searchsorted(lead, a)]]] = True
        miss = ~covered[lead]
        score = np.r_[self.score[piece], np.full(int(miss.sum()), self.unknown)]
        a, b = np.r_[a, lead[miss]], np.r_[b, lead[miss] + width[miss]]
        piece = np.r_[piece, np.full(int(miss.sum()), -1)]
        # positions count from 0 in each part, one more for its end
        of = np.searchsorted(ends, a, side="right")
        step = a - begins[of]
        sort = np.lexsort((a, step))
        a, b, piece, score, of, step = a[sort] + of[sort], b[sort] + of[sort], piece[sort], score[sort], of[sort], step[sort]
        best, back = np.full(n + len(parts), -np.inf), np.full(n + len(parts), -1)
        best[begins + np.arange(len(parts))] = 0.0
        # edges of one step and part end apart, so that no two write to one place
        cuts = np.r_[np.flatnonzero(np.r_[True, step[1:] != step[:-1]]), len(step)] if len(step) else [0]
        for x, y in zip(cuts[:-1], cuts[1:]):
            cand = best[a[x:y]] + score[x:y]
            to = b[x:y]
            win = cand > best[to]
            best[to[win]] = cand[win]
            back[to[win]] = np.arange(x, y)[win]
        return self._trace(raw, begins, ends, a, b, piece, back)

    def _trace(self, raw, begins, ends, a, b, piece, back) -> tuple[np.ndarray, np.ndarray]:
        part = np.arange(len(begins))
        first, pos = begins + part, ends + part
        edges, of = [], []
        while len(part):
            e = back[pos]
            edges.append(e)
            of.append(part)
            pos = a[e]
            go = pos > first
            part, pos, first = part[go], pos[go], first[go]
        turn = np.repeat(np.arange(len(edges)), [len(e) for e in edges])
        of, edges = np.concatenate(of), np.concatenate(edges)
        order = np.lexsort((-turn, of))
        of, edges = of[order], edges[order]
        start = a[edges] - of
        ids, width = self._pieces(raw, start, b[edges] - a[edges], piece[edges])
        return ids, np.bincount(of, width, len(begins)).astype(np.int64)

    def _pieces(self, raw, start, size, piece) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the edges in order, and how many each has: an unknown character (-1) becomes one piece for each of its bytes."""
        miss = piece < 0
        if not len(self.byte_ids):
            return np.where(miss, self.unknown_id, piece).astype(np.int32), np.ones(len(piece), np.int64)
        literal = miss & (raw[start] == _LITERAL[0])
        width = np.where(miss, np.where(literal, len(MARK.encode("utf-8")), size), 1)
        row = np.repeat(np.arange(len(piece)), width)
        k = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
        mark = np.frombuffer(MARK.encode("utf-8"), np.uint8)
        byte = np.where(literal[row], mark[np.minimum(k, len(mark) - 1)], raw[np.minimum(start[row] + k, len(raw) - 1)])
        return np.where(miss[row], self.byte_ids[np.where(miss[row], byte, 0)], piece[row]).astype(np.int32), width

    def _long(self, part: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The same for one long part: the edges of ``_WINDOW`` bytes at a time, of which each place keeps the best that ends there."""
        raw, n = np.frombuffer(part, np.uint8), len(part)
        # places count from 0 to n; the edge that wins at a place is its start and its piece
        best, come, won = np.full(n + 1, -np.inf), np.zeros(n + 1, np.int64), np.full(n + 1, -1, np.int32)
        best[0] = 0.0
        for lo in range(0, n, _WINDOW):
            hi = min(lo + _WINDOW, n)
            # a character that starts in the window ends within three bytes of it
            near = np.flatnonzero((raw[lo:hi + 4] & 0xC0) != 0x80) + lo
            width = np.diff(np.r_[near, min(hi + 4, n)])[near < hi]
            lead = near[near < hi]
            a, b, piece = self.trie.matches(raw, lead, np.full(len(lead), n))
            covered = np.zeros(hi - lo, bool)
            covered[a[b - a == width[np.searchsorted(lead, a)]] - lo] = True
            miss = ~covered[lead - lo]
            score = np.r_[self.score[piece], np.full(int(miss.sum()), self.unknown)]
            a, b = np.r_[a, lead[miss]], np.r_[b, lead[miss] + width[miss]]
            piece = np.r_[piece, np.full(int(miss.sum()), -1)]
            sort = np.argsort(a, kind="stable")
            a, b, piece, score = a[sort], b[sort], piece[sort], score[sort]
            end = int(b.max(initial=hi)) + 1
            top, edge = best[lo:end].tolist(), [-1] * (end - lo)
            for e, (x, y, s) in enumerate(zip((a - lo).tolist(), (b - lo).tolist(), score.tolist())):
                if top[x] + s > top[y]:
                    top[y], edge[y] = top[x] + s, e
            best[lo:end] = top
            edge = np.array(edge)
            new = np.flatnonzero(edge >= 0)
            come[lo + new], won[lo + new] = a[edge[new]], piece[edge[new]]
        ends, at = array("q"), n
        while at > 0:
            ends.append(at)
            at = int(come[at])
        ends = np.frombuffer(ends, np.int64)[::-1]
        found = [self._pieces(raw, come[e], e - come[e], won[e])[0] for e in np.array_split(ends, len(ends) // _WINDOW + 1)]
        return np.concatenate(found), np.array([sum(map(len, found))], np.int64)

    def decode(self, ids: Iterable[int] | None) -> str | None:
        if ids is None:
            return None
        return b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", errors="replace").removeprefix(" ")


def encode(docs: DataFrame, model: UnigramModel, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with ``out``: the piece ids of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<int>")
    def ids(text: pd.Series) -> pd.Series:
        found, texts = [], list(text)
        for at in range(0, len(texts), 1000):
            found += shared.value.encode_arrays(texts[at:at + 1000])
        return pd.Series(found, dtype=object)

    return docs.withColumn(out, ids(F.col(text_col)))


def decode(docs: DataFrame, model: UnigramModel, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``: the text of the piece ids."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else shared.value.decode(x.tolist()) for x in ids], dtype=object)

    return docs.withColumn(out, text(F.col(ids_col)))


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum up to ``most``, or of one row that is larger."""
    at = 0
    while at < len(sizes):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most, side="right")))
        yield at, end
        at = end


def encoded(docs: DataFrame, model_path: str = DEFAULT_MODEL, scores: str = "zipf") -> DataFrame:
    """doc_id, ids, counts and whether decoding gives the text back.

    A task holds the ids and decoded texts of ``_SLICE_BYTES`` of text at a time (or of one longer text), however many rows
    a batch has.
    """
    model = UnigramModel.load(model_path, scores)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), "text")
    of_id = rows.schema["doc_id"].dataType.simpleString()

    # one function for both directions, so that a text is encoded once
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            text = b.column("text")
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi in _slices(sizes, _SLICE_BYTES):
                texts = text.slice(lo, hi - lo).to_pylist()
                ids = m.encode_arrays(texts)
                null = np.array([x is None for x in ids])
                count = np.array([0 if x is None else len(x) for x in ids], np.int64)
                flat = np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)])
                ends = np.cumsum(count)
                byte = np.r_[0, np.cumsum(np.isin(flat, m.byte_ids))]
                same = [t is None or m.decode(flat[e - n:e].tolist()) == t for t, e, n in zip(texts, ends.tolist(), count.tolist())]
                offsets = pa.array(np.r_[0, ends].astype(np.int32), mask=np.r_[null, False])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), b.column("n_chars").slice(lo, hi - lo), pa.array(count, mask=null),
                     pa.array(byte[ends] - byte[ends - count], mask=null), pa.array(same), pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))],
                    ["doc_id", "n_chars", "n_pieces", "n_byte_pieces", "round_trip", "ids"])

    return rows.mapInArrow(both, f"doc_id {of_id}, n_chars long, n_pieces long, n_byte_pieces long, round_trip boolean, ids array<int>")


def op4_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents", "doc_id", "text"))
