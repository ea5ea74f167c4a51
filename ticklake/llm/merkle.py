"""Merkle manifest of a dataset: a SHA midstate tree (operator 12).

Each row is a leaf. The leaves of one tree (a language) stand in the order of their ids; every ``fanout`` consecutive
nodes become the hash of their hexadecimal texts, until one is left. The roots of the trees make a last tree in the same way.

Every parent retains copies of its hash state, one before each child slot. Folding a leaf resumes the state of its slot
with the replacement and the siblings to its right only; what stands to the left is in the state. States live where the
nodes are made: ``span`` consecutive nodes are one group and one call, several levels at a time. Above a group, the path
to the root gives one state for each level, from the siblings to the left, made once and copied for each leaf.

Plan: leaves are numbered by ``common.running``; each pass up turns groups of ``span`` nodes into one, so that 10**10 leaves
take four passes; each pass down gives nodes their path. No group is larger than ``span``, whatever a language holds.

Defined cases: a null field is ``-`` (a null text too, an empty one is ``0:``); null languages are a tree, the first one;
null ids stand first; rows with one id stand in the order of their leaf hash; equal rows are leaves of their own with equal
hashes; an empty table gives no rows; texts of any length are hashed whole; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import CRC32_SQL, running, table, written

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FANOUT = 2
#: Nodes of a group: with two children each, ten levels.
SPAN = 1024
_PATH = "array<struct<left: array<string>, right: array<string>>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in fields]), 256)


class Parent:
    """A node over ``children``, with a copy of the hash state before each child slot."""

    __slots__ = ("children", "states", "node")

    def __init__(self, children: list[str]) -> None:
        h, self.children, self.states = hashlib.sha256(), children, []
        for c in children:
            self.states.append(h.copy())
            h.update(c.encode())
        self.node = h.hexdigest()

    def fold(self, slot: int, replacement: str) -> str:
        """The node if ``replacement`` stood in ``slot``."""
        return resume(self.states[slot], replacement, self.children[slot + 1:])


def resume(state, replacement: str, right: list[str]) -> str:
    h = state.copy()
    h.update(replacement.encode())
    for r in right:
        h.update(r.encode())
    return h.hexdigest()


def levels_of(n: int, fanout: int) -> int:
    """Levels from ``n`` nodes to one."""
    k = 0
    while n > 1:
        n, k = -(-n // fanout), k + 1
    return k


def grow(nodes: list[str], levels: int, fanout: int) -> list[list[Parent]]:
    """The parents of each level above ``nodes``."""
    out = []
    for _ in range(levels):
        out.append([Parent(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)])
        nodes = [p.node for p in out[-1]]
    return out


def _levels(size: int, span: int, fanout: int) -> int:
    """Levels of a pass over a tree of ``size`` nodes: those of a whole group, or what the tree has left."""
    return levels_of(min(size, span), fanout)


def _up(nodes: DataFrame, span: int, fanout: int) -> DataFrame:
    """``tree, idx, size, node``: one node for each group of ``span``."""

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group, size = group.sort_values("idx"), int(group["size"].iloc[0])
        top = grow(list(group["node"]), _levels(size, span, fanout), fanout)
        return pd.DataFrame({"tree": [group["tree"].iloc[0]], "idx": [int(group["idx"].iloc[0]) // span], "size": [-(-size // span)],
                             "node": [top[-1][0].node if top else group["node"].iloc[0]]})

    return nodes.groupBy("tree", F.expr(f"idx div {span}")).applyInPandas(one, "tree string, idx long, size long, node string")


def _siblings(parents: list[list[Parent]], at: int, fanout: int) -> list[dict]:
    out = []
    for level in parents:
        p, slot = level[at // fanout], at % fanout
        out.append({"left": p.children[:slot], "right": p.children[slot + 1:]})
        at //= fanout
    return out


def _down(nodes: DataFrame, above: DataFrame, span: int, fanout: int) -> DataFrame:
    """``tree, idx, path`` of each node; ``above`` has that of each group."""

    def paths(group: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("idx")
        parents = grow(list(group["node"]), _levels(int(group["size"].iloc[0]), span, fanout), fanout)
        rest = _plain(over["path"].iloc[0])
        return pd.DataFrame({"tree": group["tree"], "idx": group["idx"], "path": [_siblings(parents, i, fanout) + rest for i in range(len(group))]})

    return _with_path(nodes, above, span).applyInPandas(paths, f"tree string, idx long, path {_PATH}")


def _with_path(nodes: DataFrame, above: DataFrame, span: int):
    nodes = nodes.withColumn("_group", F.expr(f"idx div {span}"))
    return nodes.groupBy("tree", "_group").cogroup(above.withColumnRenamed("idx", "_group").groupBy("tree", "_group"))


def _plain(path) -> list[dict]:
    return [{"left": list(x["left"]), "right": list(x["right"])} for x in path]


def _passes(nodes: DataFrame, span: int, fanout: int) -> list[DataFrame]:
    """``nodes`` and what each pass up makes of them, the last with one node for each tree."""
    out = [nodes]
    size = nodes.agg(F.max("size")).first()[0] or 0
    while size > 1:
        out.append(written(_up(out[-1], span, fanout), "merkle-nodes"))
        size = -(-size // span)
    return out


def _descend(levels: list[DataFrame], above: DataFrame, span: int, fanout: int) -> DataFrame:
    """The paths of the nodes of the second level, or ``above`` where there is one level only."""
    for nodes in reversed(levels[1:-1]):
        above = written(_down(nodes, above, span, fanout), "merkle-paths")
    return above


def _folded(span: int, fanout: int, columns: list[str]):
    def fold(group: pd.DataFrame, over: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("idx")
        parents = grow(list(group["node"]), _levels(int(group["size"].iloc[0]), span, fanout), fanout)
        path, subroot, root = _plain(over["path"].iloc[0]), over["subroot"].iloc[0], over["root"].iloc[0]
        states = []
        for x in path:  # one state a level, before the slot that the path comes through
            h = hashlib.sha256()
            for c in x["left"]:
                h.update(c.encode())
            states.append((h, x["right"]))
        rest = "".join(c for x in path for c in (*x["left"], *x["right"]))
        known: dict[str, str] = {}
        proofs, roots = [], []
        for i, leaf in enumerate(group["replacement"]):
            at, below = i, []
            for level in parents:
                p, slot = level[at // fanout], at % fanout
                below += p.children[:slot] + p.children[slot + 1:]
                leaf, at = p.fold(slot, leaf), at // fanout
            if (top := known.get(leaf)) is None:
                top = leaf
                for h, right in states:
                    top = resume(h, top, right)
                known[leaf] = top
            proofs.append(hashlib.sha256(("".join(below) + rest).encode()).hexdigest())
            roots.append(top)
        out = group[columns].rename(columns={"node": "leaf"})
        return out.assign(subroot=subroot, root=root, proof_sha256=proofs, folded_root=roots, verified=[r == root for r in roots])

    return fold


def manifest(leaves: DataFrame, id_col: str = "doc_id", fanout: int = FANOUT, span: int = SPAN) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root, verified of ``leaves`` (id, tree, leaf, replacement).

    ``tree`` names the tree of a leaf (null for one of its own); ``replacement`` is what is folded in place of the leaf (null: the
    leaf itself). ``span`` is a power of ``fanout``.
    """
    if fanout < 2 or fanout ** levels_of(span, fanout) != span:
        raise ValueError("span must be a power of fanout, and fanout 2 or more")
    # no null in the key, and the same order: null first, then bytewise
    named = leaves.select(F.col(id_col), F.coalesce(F.concat(F.lit("="), "tree"), F.lit("")).alias("tree"), F.col("leaf").alias("node"),
                          F.coalesce("replacement", "leaf").alias("replacement"), F.lit(1).cast("long").alias("one"))
    rows = running(named, "tree", [id_col, "node"], "one", "idx", "size").select(id_col, "tree", "idx", "size", "node", "replacement")
    rows = written(rows, "merkle-leaves")
    trees = _passes(rows.select("tree", "idx", "size", "node"), span, fanout)
    subroots = trees[-1].select("tree", "node", F.lit(1).cast("long").alias("one"), F.lit("").alias("all"))
    tops = running(subroots, "all", ["tree"], "one", "idx", "size").withColumnRenamed("tree", "name")
    tops = written(tops.select(F.col("all").alias("tree"), "idx", "size", "node", "name"), "merkle-tops")
    last = _passes(tops.select("tree", "idx", "size", "node"), span, fanout)
    # down again: from the root to each subroot, from there to each group of leaves
    top = last[-1].select("tree", "idx", F.expr(f"cast(array() as {_PATH})").alias("path"))
    of_subroots = _down(tops.select("tree", "idx", "size", "node"), _descend(last, top, span, fanout), span, fanout) if len(last) > 1 else top
    above = (tops.join(of_subroots, ["tree", "idx"]).select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("idx"), "path"))
    above = _descend(trees, written(above, "merkle-paths"), span, fanout)
    root = last[-1].select("tree", F.col("node").alias("root"))
    both = tops.join(root, "tree").select(F.col("name").alias("tree"), F.col("node").alias("subroot"), "root")
    over = above.join(both, "tree")
    of_id = dict(leaves.dtypes)[id_col]
    return _with_path(rows, over, span).applyInPandas(
        _folded(span, fanout, [id_col, "node"]),
        f"`{id_col}` {of_id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def _field_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


def _leaf_sql(count: str) -> str:
    return "sha256(" + " || ".join(_field_sql(count if c == "n_chars" else c) for c in FIELDS) + ")"


def _tree_sql(name: str, source: str) -> str:
    """Recursive levels of the trees of ``source`` (tree, idx, node): ``name`` with a level column."""
    return f"""{name} AS (
  SELECT 0 AS lvl, tree, idx, node, count(*) OVER (PARTITION BY tree) AS n FROM {source}
  UNION ALL
  SELECT lvl + 1, tree, idx // 2, sha256(string_agg(node, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM {name} WHERE n > 1 GROUP BY lvl, tree, idx // 2
)"""


SQL = {"op12_merkle": f"""WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql("n_chars")} AS node,
    CASE WHEN {CRC32_SQL.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_leaf_sql("(CAST(n_chars AS BIGINT) + 1)")} END AS changed FROM documents
),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS idx FROM docs),
{_tree_sql("low", "leaves")},
subroots AS (SELECT tree AS lang, node FROM low WHERE n = 1),
tops AS (SELECT '' AS tree, lang, row_number() OVER (ORDER BY encode(lang)) - 1 AS idx, node FROM subroots),
{_tree_sql("high", "tops")},
rooted AS (SELECT node AS root FROM high WHERE n = 1),
steps AS (
  SELECT l.doc_id, l.tree, l.idx AS leaf_idx, s.lvl AS step, s.idx, s.node FROM leaves l
  JOIN low s ON s.tree = l.tree AND s.n > 1 AND s.idx = xor(l.idx // CAST(pow(2, s.lvl) AS BIGINT), 1)
  UNION ALL
  SELECT l.doc_id, l.tree, l.idx, 1000 + s.lvl, s.idx, s.node FROM leaves l JOIN tops t ON t.lang = l.tree
  JOIN high s ON s.n > 1 AND s.idx = xor(t.idx // CAST(pow(2, s.lvl) AS BIGINT), 1)
),
proofs AS (SELECT tree, leaf_idx, sha256(string_agg(node, '' ORDER BY step)) AS proof FROM steps GROUP BY tree, leaf_idx),
folds AS (
  SELECT l.tree, l.idx AS leaf_idx, 0 AS lvl, false AS top, l.idx AS at, coalesce(l.changed, l.node) AS node, (SELECT count(*) FROM leaves x WHERE x.tree = l.tree) AS n FROM leaves l
  UNION ALL
  SELECT f.tree, f.leaf_idx, CASE WHEN f.n > 1 THEN f.lvl + 1 ELSE 0 END, f.top OR f.n = 1,
    CASE WHEN f.n > 1 THEN f.at // 2 ELSE t.idx END,
    CASE WHEN f.n = 1 THEN f.node WHEN f.at % 2 = 1 THEN sha256(s.node || f.node) ELSE sha256(f.node || coalesce(s.node, '')) END,
    CASE WHEN f.n > 1 THEN (f.n + 1) // 2 ELSE (SELECT count(*) FROM tops) END
  FROM folds f JOIN tops t ON t.lang = f.tree
  LEFT JOIN (SELECT false AS top, lvl, tree, idx, node FROM low UNION ALL SELECT true, lvl, h.tree, idx, node FROM high h) s
    ON s.top = f.top AND s.lvl = f.lvl AND s.tree = CASE WHEN f.top THEN '' ELSE f.tree END AND s.idx = xor(f.at, 1) AND f.n > 1
  WHERE f.n > 1 OR NOT f.top
)
SELECT l.doc_id, l.node AS leaf, s.node AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = root AS verified
FROM leaves l JOIN subroots s ON s.lang = l.tree JOIN rooted ON true LEFT JOIN proofs p ON p.tree = l.tree AND p.leaf_idx = l.idx
JOIN folds f ON f.tree = l.tree AND f.leaf_idx = l.idx AND f.top AND f.n = 1"""}


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, a tree for each language; where 7 divides the CRC-32 of the id, n_chars is one more in what is folded."""
    docs = table(spark, sf_dir, "documents", *FIELDS)
    cols = {c: F.col(c) for c in FIELDS}
    tampered = leaf_hash(list({**cols, "n_chars": cols["n_chars"].cast("long") + 1}.values()))
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest(docs.select("doc_id", F.col("lang").alias("tree"), leaf_hash(list(cols.values())).alias("leaf"), F.when(changed, tampered).alias("replacement")))
