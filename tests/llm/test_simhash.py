import numpy as np
import pandas as pd

from ticklake.llm.simhash import components, near_duplicates, near_links, one_per_group, op10_simhash, simhash64

SF = "/root/testdata/sf0.001"


def brute(fps, ids, limit=3):
    """Smallest id reachable over links of at most ``limit`` bits, all pairs compared."""
    v = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= limit
    label = np.array(ids, np.int64)
    while True:
        new = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (new == label).all():
            return label
        label = new


def test_query_matches_all_pairs(spark):
    out = op10_simhash(spark, SF).toPandas()
    fps = [int(x, 16) - (1 << 64) * (int(x, 16) >> 63) for x in out["fingerprint"]]
    assert out["fingerprint"].str.len().eq(16).all() and len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert list(brute(fps, out["doc_id"])) == list(out["component_id"])


def test_random_and_dense_fingerprints(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(-2**62, 2**62, 40)
    fps = set(map(int, rng.integers(-2**63, 2**63 - 1, 300)))
    for c in centre:
        for _ in range(20):
            x = int(np.uint64(np.int64(c)))
            for b in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(b)
            fps.add(int(np.uint64(x).astype(np.int64)))
    # one dense ball, so that cells are cut into sub-cells
    for _ in range(400):
        x = 0
        for b in rng.integers(0, 12, rng.integers(0, 9)):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame(pd.DataFrame({"fp": fps}))
    for limit in (1024, 16):
        edges = near_links(df, 3, cell_limit=limit)
        roots = {r["node"]: r["root"] for r in components(edges).collect()}
        got = [roots.get(x, x) for x in fps]
        assert list(brute(fps, fps)) == got


def test_fingerprint_by_hand():
    import xxhash

    assert simhash64(None) == simhash64(" \n\t") == 0
    one = xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash64("A  b") % (1 << 64) == one
    hs = [xxhash.xxh64_intdigest(x, 42) for x in (b"a b c", b"b c d", b"c d \xc3\x89")]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > 3)
    assert simhash64("A b C d É") % (1 << 64) == want


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, "alpha beta gamma", "x"), (3, "alpha beta gamma", "x"),
            (None, "alpha beta gamma", None), (9, long, None), (8, long, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r["doc_id"] or 0, r["component_id"]) for r in near_duplicates(docs).collect())
    assert got == [(0, 3), (1, 1), (2, 1), (3, 3), (3, 3), (8, 8), (9, 8)]
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 3, 8]
    assert near_duplicates(docs.limit(0)).collect() == []
