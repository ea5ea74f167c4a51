"""Conversation structure repair by a lightest-derivation agenda (operator 11).

The rows of a conversation, in the order of their turns, become a sequence of role initials of the form ``(s?(ua)+)?``.
Keep costs 0, Rerole to user or assistant 3, Delete 4, Insert of an empty user or assistant row 3; a truncated row that
is not deleted adds 3; blank rows and duplicates must go. A repair item (rows done, state of the form) is deduced from
another one and an edit; its value is (cost, audit), the audit being the initials of the edits in order. Knuth's
agenda pops the lightest item, which is then final, and deduces from it, until the goal item is popped. That is right as a
deduction never makes a value lighter (it adds cost or lengthens the audit) and keeps the order of two values of one item: audits of
equal cost over the same rows differ within the shorter one, as an audit that goes on where the other ends does so by
inserts, which cost.

Plan: rows are dealt out by range of (conversation, turn, role, start of the text), so that a conversation of any size lies
in as many partitions as it takes, and repaired in the task that reads them. A conversation at the edge of a partition, or of more
than ``MOST_ROWS`` rows or ``MOST_CHARS`` characters, goes another way: equal rows are counted before they are shuffled, first occurrences come from
an aggregate, each run of its rows in a partition yields the lightest (cost, audit) from every state to every state, and
neighbouring runs are combined, at most ``FAN_IN`` in a call, until one is left; the states between the runs then say how each run
is to be edited, again by itself.

Defined cases: a null role or text is one space, a null conversation one of its own, a null turn stands first and counts in
no gap; rows with one turn stand in the order of (role, text), so that equal rows are neighbours; a role starts with its
first character, an empty role with none, which suits no state; an empty text is blank; texts of any length are compared
whole; a conversation without rows has zeros, an empty audit and no turns; an empty table gives no rows; other columns are
not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.llm.common import CRC32_SQL, table, written

#: Costs, roles that can be given, blank characters, ends of a sentence, legal neighbours.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
GIVEN = {"u": "user", "a": "assistant"}
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}
#: States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES, GOALS = range(4), (0, 3)

MOST_ROWS, MOST_CHARS = 1000, 4_000_000
FAN_IN = 64
_CHUNK = 256

Value = tuple[int, str]
#: What the agenda sees of a row: role initial, whether it is truncated, and how often it must be deleted (0: it need not).
Row = tuple[str, bool, int]


def lightest(axioms: dict[Hashable, Value], deduce: Callable[[Hashable, Value], Iterable[tuple[Hashable, Value]]], goals: set) -> dict[Hashable, Value]:
    """Final values of the items, popped lightest first until all ``goals`` are or nothing is left. ``deduce`` has to be superior:
    no conclusion is lighter than the item that it comes from."""
    final: dict[Hashable, Value] = {}
    agenda = [(v, item) for item, v in axioms.items()]
    heapq.heapify(agenda)
    left = set(goals)
    while agenda and left:
        value, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value
        left.discard(item)
        for head, v in deduce(item, value):
            if head not in final:
                heapq.heappush(agenda, (v, head))
    return final


def repair(rows: list[Row], start: int = 0, ends: Iterable[int] = GOALS, whole: bool = True) -> dict[int, Value]:
    """The lightest (cost, audit) from ``start`` over all ``rows`` to each state of ``ends``; if ``whole``, to the lightest of them only."""
    n, ends = len(rows), set(ends)
    goal = (n + 1, -1)

    def deduce(item: tuple[int, int], value: Value) -> Iterator[tuple[tuple[int, int], Value]]:
        (i, q), (cost, audit) = item, value
        if item == goal:
            return
        if i == n and whole and q in ends:
            yield goal, value
        for c in GIVEN:
            if (q, c) in STEP:
                yield (i, STEP[q, c]), (cost + INSERT, audit + "I")
        if i == n:
            return
        initial, truncated, copies = rows[i]
        more = TRUNCATED * truncated
        if copies:
            yield (i + 1, q), (cost + DELETE * copies, audit + "D" * copies)
            return
        yield (i + 1, q), (cost + DELETE, audit + "D")
        if (q, initial) in STEP:
            yield (i + 1, STEP[q, initial]), (cost + KEEP + more, audit + "K")
        for c in GIVEN:
            if (q, c) in STEP:
                yield (i + 1, STEP[q, c]), (cost + REROLE + more, audit + "R")

    final = lightest({(0, start): (0, "")}, deduce, {goal} if whole else {(n, q) for q in ends})
    return {-1: final[goal]} if whole else {q: final[n, q] for q in ends if (n, q) in final}


def apply(rows: Iterable[tuple[str, str, int]], audit: str, state: int) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) of ``rows`` (role, text, copies of which the first may stay) after ``audit``."""
    at = 0

    def inserts() -> Iterator[tuple[str, str]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            c = next(c for c in GIVEN if (state, c) in STEP)
            state, at = STEP[state, c], at + 1
            yield GIVEN[c], ""

    for role, text, copies in rows:
        for _ in range(copies):
            yield from inserts()
            edit, at = audit[at], at + 1
            if edit != "D":
                c = role[:1] if edit == "K" else next(c for c in GIVEN if (state, c) in STEP)
                state = STEP[state, c]
                yield (role if edit == "K" else GIVEN[c]), text
    yield from inserts()


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies: the rows of the table, damaged by CRC-32 of ``conv_id:turn`` modulo 20."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(how == 4, "user").otherwise(text("role")).alias("role"),
        F.when(how == 1, "").when(how == 2, F.translate(text("text"), ENDS, "")).otherwise(text("text")).alias("text"),
        F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"))


_FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_OUT = T.StructType([T.StructField("key", T.StringType()), *[T.StructField(c, T.LongType()) for c in _FACTS], T.StructField("audit", T.StringType()),
                     T.StructField("chunk", T.LongType()), T.StructField("whole", T.BooleanType()), T.StructField("turns", _TURNS)])
_ARROW = pa.schema([("key", pa.string()), *[(c, pa.int64()) for c in _FACTS], ("audit", pa.string()), ("chunk", pa.int64()), ("whole", pa.bool_()),
                    ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


class Facts:
    """What is counted along a run of rows, and what two neighbouring runs need of each other."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn: int | None, role: str, fault: str, copies: int) -> None:
        """``copies`` equal rows; ``fault`` is that of the first, the others are blank or duplicates."""
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.blank += (copies - 1) * (fault == "blank")
        self.duplicate += (copies - 1) * (fault != "blank")
        c = role[:1]
        self.illegal += (copies - 1) * (c + c not in LEGAL) + (self.last is not None and self.last + c not in LEGAL)
        self.first, self.last = c if self.first is None else self.first, c
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def join(self, right: Facts) -> Facts:
        out = Facts()
        for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(out, k, getattr(self, k) + getattr(right, k))
        if self.last is not None and right.first is not None:
            out.illegal += self.last + right.first not in LEGAL
        out.turns -= self.high is not None and self.high == right.low
        out.first, out.last = (self.first, right.last) if self.last is not None and right.last is not None else (self.first, self.last) if right.last is None else (right.first, right.last)
        out.low, out.high = right.low if self.low is None else self.low, self.high if right.high is None else right.high
        return out

    def counts(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


def _steps(role: str, fault: str, copies: int) -> list[Row]:
    if fault in ("blank", "duplicate"):
        return [(role[:1], False, copies)]
    one = [(role[:1], fault == "truncated", 0)]
    return one + [(role[:1], False, copies - 1)] if copies > 1 else one


def _fault(text: str) -> str:
    shown = text.rstrip(BLANKS)
    return "blank" if not shown else "" if shown[-1] in ENDS else "truncated"


def _whole(key: str, rows: list[tuple]) -> dict:
    """A conversation at hand: rows of (turn, role, text, copies)."""
    facts, steps, seen = Facts(), [], set()
    for turn, role, text, copies in rows:
        fault = _fault(text)
        if fault != "blank":
            if (role, text) in seen:
                fault = "duplicate"
            seen.add((role, text))
        facts.add(turn, role, fault, copies)
        steps += _steps(role, fault, copies)
    cost, audit = repair(steps)[-1]
    turns = apply(((r, t, n) for _, r, t, n in rows), audit, 0)
    return {"key": key, **facts.counts(), "cost": cost, "audit": audit, "chunk": 0, "whole": True, "turns": [{"role": r, "text": t} for r, t in turns]}


def _stream(most_rows: int, most_chars: int):
    """Repairs the conversations that lie within a partition; of the others, the key only."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, chars, first, big, out = None, [], 0, True, False, []
        for b in batches:
            for k, turn, role, text, copies in zip(*(b.column(c).to_pylist() for c in ("key", "turn", "role", "text", "copies"))):
                if k != key:
                    if key is not None:
                        out.append({"key": key} if first or big else _whole(key, rows))
                        first = False
                    key, rows, chars, big = k, [], 0, False
                    if len(out) >= _CHUNK:
                        yield pa.RecordBatch.from_pylist(out, _ARROW)
                        out = []
                if copies and not big:
                    rows.append((turn, role, text, copies))
                    chars += len(text)
                    if len(rows) > most_rows or chars > most_chars:
                        rows, big = [], True
        if key is not None:
            out.append({"key": key})
        if out:
            yield pa.RecordBatch.from_pylist(out, _ARROW)

    return go


_RUN = T.StructType([T.StructField("key", T.StringType()), T.StructField("part", T.LongType()),
                     *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")],
                     T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
                     T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()),
                                                                      T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
                                                                      T.StructField("between", T.ArrayType(T.IntegerType()))])))])
_RUN_ARROW = pa.schema([("key", pa.string()), ("part", pa.int64()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high")],
                        ("first", pa.string()), ("last", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()),
                                                      ("between", pa.list_(pa.int32()))])))])
Spans = dict[tuple[int, int], tuple[int, str, list[int]]]


def _combine(left: Spans, right: Spans, mark: bool) -> Spans:
    """Spans over two neighbouring runs; each has a deduction for every state between, compared directly. ``mark`` notes that state."""
    out: Spans = {}
    for (q, r), (c1, a1, m1) in left.items():
        for (r2, s), (c2, a2, m2) in right.items():
            if r == r2:
                found = (c1 + c2, a1 + a2, m1 + [r] * mark + m2)
                if (q, s) not in out or found[:2] < out[q, s][:2]:
                    out[q, s] = found
    return out


def _spans_of(steps: list[Row]) -> Spans:
    return {(q, e): (*v, []) for q in STATES for e, v in repair(steps, q, STATES, whole=False).items()}


def _run_row(key: str, part: int, facts: Facts, spans: Spans) -> dict:
    return {"key": key, "part": part, **{c: getattr(facts, c) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last")},
            "spans": [{"start": q, "stop": e, "cost": c, "audit": a, "between": m} for (q, e), (c, a, m) in spans.items()]}


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each (key, part), whose rows come in order; some hundred rows at a time go through the agenda."""
    at, facts, spans, steps = None, Facts(), None, []

    def close() -> None:
        nonlocal spans, steps
        if steps or spans is None:
            new = _spans_of(steps)
            spans, steps = new if spans is None else _combine(spans, new, mark=False), []

    for b in batches:
        for k, part, turn, role, text, copies, again in zip(*(b.column(c).to_pylist() for c in ("key", "part", "turn", "role", "text", "copies", "again"))):
            if (k, part) != at:
                if at is not None:
                    close()
                    yield pa.RecordBatch.from_pylist([_run_row(*at, facts, spans)], _RUN_ARROW)
                at, facts, spans, steps = (k, part), Facts(), None, []
            if copies:
                fault = _fault(text)
                fault = "duplicate" if again and fault != "blank" else fault
                facts.add(turn, role, fault, copies)
                steps += _steps(role, fault, copies)
                if len(steps) >= _CHUNK:
                    close()
    if at is not None:
        close()
        yield pa.RecordBatch.from_pylist([_run_row(*at, facts, spans)], _RUN_ARROW)


def _fold(table_: pa.Table) -> pa.Table:
    """One run of the neighbouring runs of a conversation."""
    done = None
    for r in sorted(table_.to_pylist(), key=lambda r: r["part"]):
        facts = Facts()
        for c in ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first", "last"):
            setattr(facts, c, r[c])
        spans = {(x["start"], x["stop"]): (x["cost"], x["audit"], x["between"]) for x in r["spans"]}
        done = (facts, spans) if done is None else (done[0].join(facts), _combine(done[1], spans, mark=True))
        key, part = r["key"], r["part"]
    return pa.Table.from_pylist([_run_row(key, part // FAN_IN, *done)], _RUN_ARROW)


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of repaired rows; the first row of each (key, part) says how its rows are edited."""
    at, out, n = None, [], 0

    def chunk() -> pa.RecordBatch:
        nonlocal out, n
        n += 1
        row = {"key": at[0], "chunk": (at[1] << 32) + n, "whole": False, "turns": [{"role": r, "text": t} for r, t in out]}
        out = []
        return pa.RecordBatch.from_pylist([row], _ARROW)

    cols = ("key", "part", "role", "text", "copies", "audit", "state")
    for (key, part), rows in _grouped(zip(*(b.column(c).to_pylist() for c in cols)) for b in batches):
        head = next(rows)
        at, n, size = (key, part), 0, 0
        for turn in apply(((r[2], r[3], r[4]) for r in rows), head[5], head[6]):
            out.append(turn)
            size += len(turn[1])
            if len(out) >= _CHUNK or size > MOST_CHARS:
                yield chunk()
                size = 0
        if out:
            yield chunk()


def _grouped(batches: Iterable[Iterable[tuple]]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with the same first two values, over the borders of batches."""
    yield from itertools.groupby((r for b in batches for r in b), key=lambda r: r[:2])


def _long(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The conversations of ``keys``, each by its runs."""
    # equal rows are one row with their number, before anything is shuffled
    rows = rows.join(keys, "key", "left_semi").groupBy("key", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = written(rows.withColumn("digest", F.md5("text")), "repair-rows")
    first = rows.filter("copies > 0").groupBy("key", "role", "digest").agg(F.min(F.struct("turn")).alias("f"))
    again = F.coalesce(~F.col("turn").eqNullSafe(F.col("f.turn")), F.lit(False))
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64)]
    rows = rows.join(first, ["key", "role", "digest"], "left").select("key", "turn", "role", "text", "copies", again.alias("again"))
    rows = (rows.repartitionByRange(*order).sortWithinPartitions(*order[:3], "text")
            .withColumn("row", F.monotonically_increasing_id()))
    rows = written(rows, "repair-long").withColumn("part", F.shiftright("row", 33))
    dealt = rows.repartition("key", "part").sortWithinPartitions("key", "part", "row")
    runs = written(dealt.mapInArrow(_runs, _RUN), "repair-runs")
    folded, parts = runs, runs.agg(F.max("part")).first()[0]
    while parts:
        folded, parts = folded.groupBy("key", F.expr(f"part div {FAN_IN}")).applyInArrow(_fold, _RUN), parts // FAN_IN
    # from the start to the lighter goal; an array of structs sorts by its first fields
    ends = F.filter("spans", lambda x: (x["start"] == 0) & x["stop"].isin(*GOALS))
    best = F.array_min(F.transform(ends, lambda x: F.struct(x["cost"].alias("cost"), x["audit"].alias("audit"), x["stop"].alias("stop"), x["between"].alias("between"))))
    folded = written(folded.withColumn("best", best).drop("spans", "part"), "repair-folded")
    facts = folded.select("key", F.coalesce(F.expr("high - low + 1 - turns"), F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit",
                          F.lit(0).cast("long").alias("chunk"), F.lit(False).alias("whole"), F.expr("cast(array() as array<struct<role: string, text: string>>)").alias("turns"))
    # the states around each run, by its place in its conversation
    place = F.expr("row_number() over (partition by key order by part)")
    marks = folded.select("key", F.posexplode(F.concat(F.array(F.lit(0)), "best.between")).alias("at", "state"), F.concat("best.between", F.array("best.stop")).alias("after"))
    marks = marks.select("key", (F.col("at") + 1).alias("place"), "state", F.expr("after[at]").alias("stop"))
    span = F.expr("filter(spans, x -> x.start = state and x.stop = stop)[0].audit")
    heads = (runs.select("key", "part", "spans", place.alias("place")).join(marks, ["key", "place"])
             .select("key", "part", F.lit(-1).cast("long").alias("row"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(0).cast("long").alias("copies"), span.alias("audit"), "state"))
    body = rows.select("key", "part", "row", "role", "text", "copies", F.lit("").alias("audit"), F.lit(0).alias("state"))
    edited = (heads.unionByName(body).repartition("key", "part").sortWithinPartitions("key", "part", "row").drop("row").mapInArrow(_edit, _OUT))
    return facts.unionByName(edited)


def repaired(rows: DataFrame, id_col: str = "conv_id", most_rows: int = MOST_ROWS, most_chars: int = MOST_CHARS) -> DataFrame:
    """The repaired conversations of ``rows`` (id, turn, role, text, copies; 0 copies: the row is not there, but its conversation is).

    Columns: id, gaps, blank, duplicate, truncated, illegal, cost, audit, chunk, whole, turns (role, text). Most conversations are one row, with
    ``whole``; a long one has its facts in a row with chunk 0 and its turns in further rows, in the order of ``chunk``.
    """
    of_id = dict(rows.dtypes)[id_col]
    # no null in the key
    key = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    rows = rows.select(key.alias("key"), "turn", "role", "text", F.col("copies").cast("long").alias("copies"))
    order = [F.col("key"), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64)]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order[:3], "text")
    first = written(dealt.mapInArrow(_stream(most_rows, most_chars), _OUT), "repair-first")
    parts = written(_long(rows, first.filter("whole is null").select("key").distinct()), "repair-parts")
    out = first.filter("whole").unionByName(parts)
    return out.select(F.when(F.col("key") != "", F.expr("substring(key, 2)")).cast(of_id).alias(id_col), *[c for c in out.columns if c != "key"])


def _line(turn: Column) -> Column:
    return F.concat(turn["role"], F.lit(":"), turn["text"])


def _hashed(id_col: str):
    """One row for each long conversation: its facts, and the hash of its chunks in order."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None, None)  # facts, hash, whether it has a line yet
        for b in batches:
            for r in b.to_pylist():
                if not r["chunk"]:
                    if last[0]:
                        yield pa.RecordBatch.from_pylist([{**last[0], "repaired_sha256": last[1].hexdigest()}], schema)
                    schema = pa.schema([f for f in b.schema if f.name not in ("chunk", "whole", "turns")] + [pa.field("repaired_sha256", pa.string())])
                    last = ({k: r[k] for k in (id_col, *_FACTS, "audit")}, hashlib.sha256(), False)
                for t in r["turns"]:
                    last[1].update(("\n" * last[2] + t["role"] + ":" + t["text"]).encode())
                    last = (*last[:2], True)
        if last[0]:
            yield pa.RecordBatch.from_pylist([{**last[0], "repaired_sha256": last[1].hexdigest()}], schema)

    return go


def digests(out: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """id, the facts, audit and the SHA-256 of the repaired ``role:text`` lines of ``repaired``; a long conversation streams through one hash."""
    cols = [id_col, *_FACTS, "audit"]
    whole = out.filter("whole").select(*cols, F.sha2(F.array_join(F.transform("turns", _line), "\n"), 256).alias("repaired_sha256"))
    parts = out.filter("not whole").repartition(F.col(id_col)).sortWithinPartitions(id_col, "chunk")
    return whole.unionByName(parts.mapInArrow(_hashed(id_col), whole.schema))


_KEY_SQL = "(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))"
_BLANKS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = {"op11_conversation_repair": f"""WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC32_SQL.format(_KEY_SQL)} % 20 AS how FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE how WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM given
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, {_BLANKS_SQL}) AS shown,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM damaged
),
faults AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM numbered
),
step(q, c, r, name) AS (VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user:'), (1, 'u', 2, 'user:'), (2, 'a', 3, 'assistant:'), (3, 'u', 2, 'user:')),
-- what can be inserted at one place, an empty sequence included
gap(q, r, k, lines) AS (
  SELECT q, q, 0, CAST([] AS VARCHAR[]) FROM (VALUES (0), (1), (2), (3)) t(q)
  UNION ALL
  SELECT g.q, s.r, k + 1, list_append(lines, s.name) FROM gap g JOIN step s ON s.q = g.r AND s.name IS NOT NULL WHERE k < 2
),
edits AS (
  SELECT f.conv_id, i, q, q AS r, 4 AS cost, 'D' AS letter, CAST([] AS VARCHAR[]) AS lines FROM faults f, (VALUES (0), (1), (2), (3)) t(q)
  UNION ALL
  SELECT f.conv_id, i, s.q, s.r, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K', [role || ':' || text] FROM faults f JOIN step s ON s.c = initial WHERE fault IN ('', 'truncated')
  UNION ALL
  SELECT f.conv_id, i, s.q, s.r, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R', [s.name || text] FROM faults f JOIN step s ON s.name IS NOT NULL WHERE fault IN ('', 'truncated')
),
best AS (
  SELECT DISTINCT conv_id, 0 AS i, g.r AS q, {{'cost': 3 * k, 'audit': repeat('I', k), 'lines': lines}} AS v FROM conversations JOIN gap g ON g.q = 0
  UNION ALL
  SELECT b.conv_id, b.i + 1, g.r, min({{'cost': v.cost + e.cost + 3 * k, 'audit': v.audit || letter || repeat('I', k), 'lines': v.lines || e.lines || g.lines}})
  FROM best b JOIN edits e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i + 1 AND e.q = b.q JOIN gap g ON g.q = e.r
  GROUP BY b.conv_id, b.i + 1, g.r
),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM faults GROUP BY conv_id
),
ids AS (SELECT DISTINCT conv_id FROM conversations),
every AS (SELECT ids.conv_id, gaps, blank, duplicate, truncated, illegal, n FROM ids LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id),
won AS (
  SELECT e.conv_id, min(v) AS v FROM every e JOIN best b ON b.conv_id IS NOT DISTINCT FROM e.conv_id AND b.i = coalesce(n, 0) AND b.q IN (0, 3) GROUP BY e.conv_id
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(v.cost AS BIGINT) AS cost, v.audit AS audit, sha256(coalesce(array_to_string(v.lines, chr(10)), '')) AS repaired_sha256
FROM every e JOIN won w ON w.conv_id IS NOT DISTINCT FROM e.conv_id"""}


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the damaged table: gaps, faults, lightest cost and audit, hash of the repaired lines."""
    return digests(repaired(damaged(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))))
