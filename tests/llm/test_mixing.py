import re
from collections import Counter

import numpy as np
import pytest

from ticklake.llm.mixing import WORD, drawn, mix, op13_mixing, permuted, targets

SF = "/root/testdata/sf0.001"


def plain_targets(words, weights=(5, 2, 1), most=3):
    names = sorted((s for s in words if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in words else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(words.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        share = (total - sum(most * words[s] for s in full)) / sum(w[s] for s in rest) if rest else 0
        over = {s for s in rest if w[s] * share > most * words[s]}
        if not over:
            return {s: most * words[s] if s in full else w[s] * share for s in names}
        full |= over


def plain_mix(docs, block, target, seed=13, most=3):
    """Words taken of each document: the packing and permutations one source at a time. docs: (id, source, size) in order of id."""
    taken = Counter()
    for s in {d[1] for d in docs}:
        owner = [i for i, d in enumerate(docs) if d[1] == s for _ in range(d[2])]
        blocks = [owner[i:i + block] for i in range(0, len(owner), block)]
        n, left, name = len(blocks), round(target[s]), "1" if s is None else "0" + s
        for j in range(most * n):
            taken.update(blocks[int(permuted(np.array([j % n]), n, seed, name, j // n)[0])][:left])
            left -= min(left, len(blocks[int(permuted(np.array([j % n]), n, seed, name, j // n)[0])]))
        assert left == 0
    return [taken[i] for i in range(len(docs))]


def test_permutations_and_draws():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        one, two = permuted(np.arange(n), n, "k", 1), permuted(np.arange(n), n, "k", 2)
        assert list(permuted(one, n, "k", 1, back=True)) == list(range(n))
        assert sorted(one) == sorted(two) == list(range(n)) and (n < 16 or list(one) != list(two))
    for shards in (1, 2, 3, 7, 64):
        for count in (0, 1, 10, 1000):
            whole = sorted(drawn(count, shards, 0, 0, "x"))
            firsts = np.cumsum([0] + [c for _, _, c in whole])
            assert [f for _, f, _ in whole] == list(firsts[:-1]) and firsts[-1] == count
            for depth in (1, 2, 5):
                assert sorted(x for p in range(1 << depth) for x in drawn(count, shards, p, depth, "x")) == whole
    spread = np.array([c for _, _, c in sorted(drawn(64_000, 64, 0, 0, "y"))])
    # multinomial: variance of a count near its mean
    assert len(spread) == 64 and 500 < spread.var() < 1600


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 50, None: 7}, {"a": 1, "b": 1000, "c": 0}, {"a": 0, None: 0}, {"é": 10, "z": 900, "Z": 3, "a": 3, "b": 2, "": 4}])
def test_targets(spark, sizes):
    rows = [("1" if s is None else "0" + s, n) for s, n in sizes.items()]
    got = {r["name"]: r["target"] for r in targets(spark.createDataFrame(rows, "name string, words long")).collect()}
    want = plain_targets(sizes)
    assert {("1" if s is None else "0" + s): pytest.approx(t) for s, t in want.items()} == got
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


@pytest.mark.parametrize("block,part", [(4, 8), (128, 1 << 18)])
def test_against_a_plain_mix(spark, block, part):
    docs = sorted(([i, None if i % 11 == 0 else f"s{i % 5 if i % 2 else 0}", (i * 37) % 90] for i in range(300)), key=lambda d: d[0])
    frame = spark.createDataFrame([(i, s, " ".join(["w"] * n) if n else None) for i, s, n in docs], "doc_id long, source string, text string")
    rows, sources, spans = mix(frame, block_words=block, part_slots=part, shard_slots=16)
    words = Counter()
    for _, s, n in docs:
        words[s] += n
    target = plain_targets(words)
    got = {r["id"]: 0 for r in rows.collect()}
    by_row = {r["row"]: r["id"] for r in rows.collect()}
    spans = spans.collect()
    for r in spans:
        got[by_row[r["row"]]] += r["hi"] - r["lo"]
    assert [got[i] for i, _, _ in docs] == plain_mix(docs, block, target)
    # each slot once, and the words of a block in it
    assert len({(r["name"], r["slot"]) for r in spans}) == len({(r["name"], r["slot"], r["shard"], r["block"]) for r in spans})
    held = Counter()
    for r in spans:
        held[r["name"], r["slot"]] += r["hi"] - r["lo"]
    assert max(held.values()) == block if block < 100 else max(held.values()) <= block


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    size = {r["doc_id"]: len(re.findall(WORD, r["text"] or "")) for r in docs}
    words = Counter()
    for r in docs:
        words[r["source"]] += size[r["doc_id"]]
    target = plain_targets(words)
    of = {r["doc_id"]: r["source"] for r in docs}
    got = op13_mixing(spark, SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(size)
    taken = Counter()
    for r in got:
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], words[of[r["doc_id"]]]) and r["target"] == pytest.approx(target[of[r["doc_id"]]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[of[r["doc_id"]]] += r["taken"]
    assert all(taken[s] == round(target[s]) for s in words)
    assert sorted(map(tuple, got)) == sorted(map(tuple, op13_mixing(spark, SF).collect()))


def test_odd_rows(spark, workdir):
    rows = [(1, None, None), (1, "s", "a b c"), (1, "s", "a b c"), (None, "s", "d"), (2, "s", ""), (3, "t", "w " * 30_000), (4, "u", " \t\x1f")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "'k' as name", "1 as size", "2 as row", "3 as block", "4 as target")
    for name, part in (("some", docs), ("none", docs.limit(0))):
        part.write.parquet(f"{workdir}/{name}/documents.parquet")
    got = op13_mixing(spark, f"{workdir}/some").collect()
    assert sorted(r["size"] for r in got) == [0, 0, 1, 1, 3, 3, 30_000] and all(r["taken"] <= 3 * r["size"] for r in got)
    assert sum(r["target"] for r in got if r["doc_id"] in (3, 4)) == pytest.approx(30_008 - 21)
    assert op13_mixing(spark, f"{workdir}/none").collect() == []
