import random

from ticklake.llm.decontaminate import SuffixAutomaton, decontaminate, find_hits, normalised_words


def brute(words, items, window):
    hit, found, longest = set(), set(), 0
    for item, w in items:
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            for p in range(len(words) - k + 1):
                if words[p:p + k] == w[i:i + k]:
                    hit |= set(range(p, p + k))
                    found.add(item)
        for p in range(len(words)):
            for i in range(len(w)):
                n = 0
                while p + n < len(words) and i + n < len(w) and words[p + n] == w[i + n]:
                    n += 1
                longest = max(longest, n)
    return hit, found, longest


def test_automaton_matches_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        items = [(str(i), [rng.choice(b"abc") for _ in range(rng.randint(0, 9))]) for i in range(rng.randint(0, 6))]
        words = [rng.choice(b"abcd") for _ in range(rng.randint(0, 30))]
        window = rng.randint(1, 5)
        spans, found, longest = SuffixAutomaton(items, window).scan(words)
        covered = {i for a, b in spans for i in range(a, b)}
        assert (covered, found, longest) == brute(words, items, window)
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_words():
    assert normalised_words("Ab-c9 É_x\n") == [b"ab", b"c9", "É".encode(), b"x"]
    assert normalised_words(None) == []


def test_blocks_and_removal(spark):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice((3, 14, 20))))) for i in range(12)] + [(50, None), (51, " ")]
    docs = []
    for i in range(40):
        w = [rng.choice(vocab) for _ in range(30)]
        if i % 3 == 0:
            w[5:5] = items[i % 12][1].split()
        docs.append((i, ", ".join(w), "own"))
    docs += [(100, None, None), (101, "", "x"), (None, items[0][1], "x"), (200, items[0][1], "x"), (200, items[0][1], "x"),
             (102, "q " * 100_000 + items[1][1], "long")]
    d = spark.createDataFrame(docs, "doc_id int, text string, hits string")
    b = spark.createDataFrame(items, "item_id int, text string")
    one = find_hits(d, b, out="h").select("doc_id", "text", "h.*").collect()
    many = find_hits(d, b, out="h", max_block_words=40).select("doc_id", "text", "h.*").collect()
    key = lambda r: (r["doc_id"] or -1, r["text"] or "", r["n_words"], sorted(r["items"]), [list(s) for s in r["spans"]], r["longest"])
    assert sorted(map(key, one)) == sorted(map(key, many))
    named = [(str(i), normalised_words(t)) for i, t in items]
    for r in one:
        if r["doc_id"] == 102:
            continue
        hit, found, longest = brute(normalised_words(r["text"]), named, 10)
        assert {i for a, e in r["spans"] for i in range(a, e)} == hit and set(r["items"]) == found
    strict = decontaminate(d, b)
    assert strict.columns == d.columns
    assert sorted(r["doc_id"] or -1 for r in strict.collect()) == sorted(r["doc_id"] or -1 for r in one if not r["items"])
    cut = {r["doc_id"]: r["text"] for r in decontaminate(d, b, max_coverage=0.9).collect()}
    for r in one:
        if r["items"] and r["doc_id"] in cut and len(r["text"]) < 10_000:
            w = normalised_words(r["text"])
            gone = {i for a, e in r["spans"] for i in range(a, e)}
            assert normalised_words(cut[r["doc_id"]]) == [x for i, x in enumerate(w) if i not in gone]
    assert decontaminate(d.limit(0), b).collect() == [] and decontaminate(d, b.limit(0)).count() == len(docs)


def test_items_without_an_id_still_hit(spark):
    words = [" ".join(f"{c}{i}" for i in range(12)) for c in "abc"]
    items = spark.createDataFrame([(None, words[0]), (None, words[1]), (7, words[2]), (8, None)], "item_id int, text string")
    docs = spark.createDataFrame([(1, f"{words[0]} x {words[1]}"), (2, f"{words[0]} {words[2]}"), (3, "free of it")], "doc_id int, text string")
    for size in (200_000, 12):
        got = {r["doc_id"]: r["h"] for r in find_hits(docs, items, out="h", max_block_words=size).collect()}
        assert [[list(s) for s in got[i]["spans"]] for i in (1, 2, 3)] == [[[0, 12], [13, 25]], [[0, 24]], []]
        # as in the SQL, which counts a null id as one item
        assert [got[i]["items"] for i in (1, 2, 3)] == [[None], ["7", None], []]
        assert [r["doc_id"] for r in decontaminate(docs, items, max_block_words=size).collect()] == [3]
