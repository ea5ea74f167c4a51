import hashlib
import random
from collections import Counter

import numpy as np

from ticklake.llm.repeats import contexts, merge_shards, op7_repeats, remove_repeats

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    bodies = [(t or "").encode("utf-8") for t in texts]
    places = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if places[b[i:i + length]] > 1:
                gone[i + 1:i + 1 + length] = True
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_merge_orders_suffixes_and_finds_common_prefixes():
    rng = random.Random(1)
    for _ in range(60):
        shards = [bytes(rng.choice(b"ab\xff\x00") for _ in range(rng.randint(1, 60))) * rng.choice((1, 1, 2)) for _ in range(rng.randint(1, 6))]
        length = rng.choice((8, 9, 15, 40))
        block, size, prefix = merge_shards(shards, length)
        at, seen, rows = 0, Counter(), {}
        suffixes = []
        for b in shards:
            suffixes += [b[i:] for i in range(len(b))] + [b""]
        assert sorted(size[np.unique(block, return_index=True)[1]].tolist()) == sorted(Counter(block.tolist()).values())
        for i, x in enumerate(suffixes):
            if len(x) >= length:
                seen[x[:length]] += 1
                rows.setdefault(x[:length], set()).add(int(block[i]))
        for i, x in enumerate(suffixes):
            assert size[i] == (seen[x[:length]] if len(x) >= length else 1)
        assert all(len(v) == 1 for v in rows.values())
        names = sorted(rows)
        assert [min(rows[x]) for x in names] == sorted(min(rows[x]) for x in names)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(2)
    x = rng.integers(97, 100, 900).astype(np.uint8)
    raw = np.concatenate([x[:500], rng.integers(97, 100, 333).astype(np.uint8), x[100:450]])
    h, first, end = contexts(raw, 40)
    of = np.repeat(h, end - first)
    assert len(of) == len(raw) - 39
    by = {}
    for i in range(len(of)):
        assert by.setdefault(raw[i:i + 40].tobytes(), of[i]) == of[i]


def made(seed):
    rng = random.Random(seed)
    words = [f"wörd{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [text(rng.randint(5, 120)) for _ in range(25)]
    passage = text(45)
    near = [b[:rng.randint(0, len(b))] + "#" + b[rng.randint(0, len(b)):] for b in base for _ in range(3)]
    lined = [text(rng.randint(1, 20)) + " " + passage + " " + text(rng.randint(1, 20)) for _ in range(30)]
    return base + base[:5] + near + lined + ["ab" * 300, "", None, "x" * 199, "x" * 199, "y" * 200, text(20_000)]


def test_made_documents_match_brute_force(spark):
    texts = made(3)
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id int, text string, key int")
    want = brute(texts, 200)
    for limit in (100_000, 4):
        got = remove_repeats(docs, group_limit=limit).orderBy("doc_id").collect()
        assert [(r["n_bytes"], sum(b - a for a, b in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got] == want


def test_a_passage_in_thousands_of_texts(spark):
    rng = random.Random(9)
    passage = " ".join(rng.choice("river stone cloud haven moor lantern task birch quote sell".split()) + str(i) for i in range(50))
    texts = [f"{i} {i * 7919} {passage} {i * 104729} end" for i in range(5000)] + ["z " + passage[:150], passage[1:230] + "q"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    want = brute(texts, 200)
    got = remove_repeats(docs).orderBy("doc_id").collect()
    assert [(r["n_bytes"], sum(b - a for a, b in r["spans"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got] == want


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op7_repeats(spark, SF).collect()}
    assert [got[r["doc_id"]] for r in docs] == brute([r["text"] for r in docs], 200)


def test_defined_cases(spark):
    long = " ".join(f"q{i * 7919 % 10007}" for i in range(100))
    rows = [(1, None), (1, None), (2, ""), (None, "z" * 10), (3, long), (3, long), (4, "z" * 201)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = sorted((r["doc_id"] or 0, r["n_bytes"], len(bytes(r["kept"]))) for r in remove_repeats(docs).collect())
    assert got == sorted([(1, 0, 0), (1, 0, 0), (2, 0, 0), (0, 10, 10), (3, len(long), 0), (3, len(long), 0), (4, 201, 0)])
    assert remove_repeats(docs.limit(0)).collect() == []
