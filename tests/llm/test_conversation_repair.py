import hashlib
import random
import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from ticklake.llm.conversation_repair import SQL, apply, damaged, digests, lightest, op11_conversation_repair, repair, repaired

SF = "/root/testdata/sf0.001"
FORM = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """The least (cost, audit) over every sequence of edits no dearer than deleting all rows; rows: (initial, truncated, must go)."""
    most, found = 4 * len(rows), []

    def go(i, cost, audit, roles):
        if cost > most:
            return
        if i == len(rows) and FORM.fullmatch(roles):
            found.append((cost, audit))
        for c in "ua":
            if cost + 3 <= most:
                go(i, cost + 3, audit + "I", roles + c)
        if i < len(rows):
            initial, truncated, gone = rows[i]
            go(i + 1, cost + 4, audit + "D", roles)
            if not gone:
                go(i + 1, cost + 3 * truncated, audit + "K", roles + (initial or "-"))
                for c in "ua":
                    go(i + 1, cost + 3 + 3 * truncated, audit + "R", roles + c)

    go(0, 0, "", "")
    return min(found)


@given(st.lists(st.tuples(st.sampled_from(["s", "u", "a", "t", ""]), st.booleans(), st.booleans()), max_size=3))
@settings(max_examples=120, deadline=None)
def test_agenda_against_every_edit_sequence(rows):
    assert repair([(c, t, int(g)) for c, t, g in rows])[-1] == brute(rows)


def test_agenda_pops_in_order():
    edges = {"a": [("b", 2, "x"), ("c", 1, "y")], "c": [("b", 1, "a"), ("goal", 9, "z")], "b": [("goal", 3, "b")]}
    final = lightest({"a": (0, "")}, lambda item, v: [(h, (v[0] + w, v[1] + e)) for h, w, e in edges.get(item, [])], {"goal"})
    # at equal cost the lesser audit: xb against yab
    assert final == {"a": (0, ""), "c": (1, "y"), "b": (2, "x"), "goal": (5, "xb")}


def test_apply():
    rows = [("system", "S.", 1), ("user", "x", 2), ("tool", "y", 1)]
    assert list(apply(rows, "KKDR", 0)) == [("system", "S."), ("user", "x"), ("assistant", "y")]
    assert list(apply([], "II", 0)) == [("user", ""), ("assistant", "")] and list(apply(rows[:1], "D", 0)) == []


def plain(table):
    """The contract for rows (conv_id, turn, role, text) that are damaged already."""
    out = {}
    for conv in {r[0] for r in table}:
        rows = sorted((r[1:] for r in table if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        faults, seen = [], set()
        for _, role, text in rows:
            shown = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        cost, audit = brute([(r[1][:1], f == "truncated", f in ("blank", "duplicate")) for r, f in zip(rows, faults)])
        lines = [f"{r}:{t}" for r, t in apply([(r, t, 1) for _, r, t in rows], audit, 0)]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def by_id(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_both_ways_against_a_plain_version(spark):
    draw = random.Random(5)
    rows = [(conv, draw.choice([None, 1, 2, 3, 7]), draw.choice(["system", "user", "assistant", "tool", ""]), draw.choice(["Yes.", "Yes.", "No", " \t", "", "Why? \n"]))
            for conv in [None, *range(20)] for _ in range(draw.randint(1, 3))]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id int, turn long, role string, text string, copies int").selectExpr("*", "'k' as key", "1 as part", "'x' as spans")
    want = plain(rows)
    assert by_id(digests(repaired(table))) == want
    # every conversation by its runs
    assert by_id(digests(repaired(table, most_rows=0))) == want


def test_a_conversation_over_many_partitions(spark):
    draw = random.Random(7)
    rows = [(1, draw.choice([None, *range(700)]), draw.choice(["system", "user", "assistant"]), draw.choice(["One.", "Two", "", f"Some {i}."])) for i in range(3000)]
    rows += [(2, 5, "user", "the same words.")] * 3000 + [(3, 1, "user", "Short?"), (3, 2, "assistant", "Yes.")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id int, turn long, role string, text string, copies int").repartition(7)
    short = by_id(digests(repaired(table, most_rows=10_000)))
    spark.conf.set("spark.sql.shuffle.partitions", "90")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        long = by_id(digests(repaired(table, most_rows=20)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert long == short and set(long) == {1, 2, 3}
    assert long[2][:6] == (0, 0, 2999, 0, 2999, 4 * 2999 + 3) and long[2][6] == "K" + "D" * 2999 + "I" and long[3][5:7] == (0, "KK")


def test_query_equals_sql(spark, workdir):
    rows = [(1, None, None, None), (None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (2, 1, "user", "w " * 200_000), (3, 1, "user", "Again."), (3, 1, "user", "Again."),
            (3, 2, "assistant", "Ok.")] + [(10 + i, t, r, f"{r} {t}.") for i in range(30) for t, r in enumerate(["system", "user", "assistant", "user"])]
    some = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string").selectExpr("*", "'a' as audit", "1 as copies", "2 as chunk")
    for name, part in (("some", some), ("none", some.limit(0))):
        part.write.parquet(f"{workdir}/{name}/conversations.parquet")
    assert op11_conversation_repair(spark, f"{workdir}/none").collect() == []
    for sf, files in ((SF, "conversations.parquet"), (f"{workdir}/some", "conversations.parquet/*.parquet")):
        c = duckdb.connect()
        c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/{files}'")
        got = op11_conversation_repair(spark, sf)
        res = c.execute(SQL["op11_conversation_repair"])
        assert [d[0] for d in res.description] == got.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(res.fetchall(), key=repr)
    assert damaged(some).count() == len(rows)
