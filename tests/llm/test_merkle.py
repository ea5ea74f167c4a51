import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticklake.llm.merkle import SQL, Parent, grow, levels_of, manifest, op12_merkle

SF = "/root/testdata/sf0.001"


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def plain(rows, fanout):
    """The contract, a list at a time; rows: (id, tree, leaf, replacement)."""
    trees = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, r[2])):
        trees.setdefault(r[1], []).append(r)

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + fanout]) for i in range(0, len(levels[-1]), fanout)])
        return levels

    low = {k: climb([r[2] for r in v]) for k, v in trees.items()}
    high = climb([x[-1][0] for x in low.values()])
    out = []
    for place, (k, v) in enumerate(trees.items()):
        for i, (doc, _, leaf, new) in enumerate(v):
            node, sibs = new or leaf, []
            for levels, at in ((low[k], i), (high, place)):
                for level in levels[:-1]:
                    run = level[at // fanout * fanout:(at // fanout + 1) * fanout]
                    sibs += run[:at % fanout] + run[at % fanout + 1:]
                    node = h(*run[:at % fanout], node, *run[at % fanout + 1:])
                    at //= fanout
            root = high[-1][0]
            out.append((doc, leaf, low[k][-1][0], root, h(*sibs), node, node == root))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("fanout,span", [(2, 4), (3, 9), (2, 1024)])
def test_against_plain_trees(spark, fanout, span):
    rows = [(i, "en" if i % 3 else "de", h(str(i)), h("new", str(i)) if i % 7 == 0 else None) for i in range(150)]
    rows += [(5, "en", h("again"), None), (5, "en", h("again"), None), (None, "en", h("n"), None), (7, None, h("l"), h("m")), (8, "é", h("8"), None)]
    rows += [(900 + i, f"x{i}", h("x", str(i)), None) for i in range(9)]
    leaves = spark.createDataFrame(rows, "doc_id long, tree string, leaf string, replacement string")
    assert order(manifest(leaves, fanout=fanout, span=span).collect()) == order(plain(rows, fanout))


@given(st.integers(1, 40), st.integers(2, 5), st.data())
@settings(max_examples=40, deadline=None)
def test_a_state_resumed_equals_the_whole_hash(n, fanout, data):
    nodes = [h(str(i)) for i in range(n)]
    for p in [x for level in grow(nodes, levels_of(n, fanout), fanout) for x in level]:
        slot = data.draw(st.integers(0, len(p.children) - 1))
        assert p.fold(slot, "r") == h(*p.children[:slot], "r", *p.children[slot + 1:])
    assert Parent(["a"]).node == h("a")


def test_query_is_its_contract(spark):
    import duckdb

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    enc = lambda *v: "".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in v)
    rows = []
    for r in docs.collect():
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
        leaf = lambda n: h(enc(r["doc_id"], r["source"], r["lang"], n, r["text"]))  # noqa: E731, B023
        rows.append((r["doc_id"], r["lang"], leaf(r["n_chars"]), leaf(r["n_chars"] + 1) if changed else None))
    got = op12_merkle(spark, SF).collect()
    assert order(got) == order(plain(rows, 2)) and {r["verified"] for r in got} == {True, False}
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert order(c.execute(SQL["op12_merkle"]).fetchall()) == order(got)


def test_odd_rows(spark, workdir):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "s", "en", 3, ""), (None, "s", "en", 3, "a"), (3, "s", None, None, "w" * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string").selectExpr("*", "'x' as tree", "1 as idx", "'n' as node")
    for name, part in (("some", docs), ("none", docs.limit(0))):
        part.write.parquet(f"{workdir}/{name}/documents.parquet")
    got = op12_merkle(spark, f"{workdir}/some").collect()
    assert len(got) == 5 and len({r["root"] for r in got}) == 1 and len({r["subroot"] for r in got}) == 2
    # a null count stays null, so that tampering cannot show
    assert all(r["verified"] for r in got if r["doc_id"] != 2)
    assert op12_merkle(spark, f"{workdir}/none").collect() == []
    one = spark.createDataFrame([(4, "en", h("4"), None)], "doc_id long, tree string, leaf string, replacement string")
    assert [tuple(r) for r in manifest(one).collect()] == [(4, h("4"), h("4"), h("4"), h(), h("4"), True)]
    with pytest.raises(ValueError):
        manifest(one, fanout=3, span=1024)
