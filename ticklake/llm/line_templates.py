"""Line dedup by a fixed-depth log-template tree, on built-in expressions (operator 9).

A line is cut into tokens; a token with a digit is a variable field at once. The
tree has a fixed depth: the first level is the token count, the next
``depth`` levels are the leading tokens. Within a leaf, each position keeps the tokens
that at least one in ``max_children`` of the leaf's lines has there (so at most that many);
all others share one child, a variable field. That is a share of the lines, so that it does not turn
over with the size of the corpus. A line's template is its tokens with the variable fields
as ``<*>``, and its masked line is a template of its own, whatever else its leaf holds. A template needs
``min_fixed`` of its tokens fixed, one with fields of its leaf as much of those after the leading ones
too, which are fixed in any case. Found in at least ``min_docs`` documents, it is boilerplate:
its lines are dropped from every document.

Scale: leaves and templates are counted by partial aggregates of hashes; only
lines whose leaf occurs in ``min_docs`` documents or more go further, once for
each document and distinct masked line; no leaf, template or document is ever
gathered into one task. A leaf's fields are at most ``max_children`` tokens a position.

Defined cases: a null text stays null and has no lines; a blank line has no
template and stays; line ends are ``\\n``; documents are told apart by id, so
rows that repeat an id count once for a template, and each row loses the lines;
rows with a null id count as one document; with ``groups`` (the pipeline)
near copies count once too; a document of one line of any length has one template;
an empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import cut, table, written
from ticklake.llm.simhash import components

_SPACE = r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+"
_FIELD = "<*>"


def _masked(line: Column) -> Column:
    """Tokens of a line, single-spaced, those with a digit as fields."""
    plain = F.trim(F.regexp_replace(line, _SPACE, " "))
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", _FIELD)).otherwise(plain)


def _lines(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """Distinct masked lines of each document: id, leaf, masked, line (hash)."""
    rows = docs.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.transform(F.split(F.col(text_col), "\n"), _masked))).alias("masked"))
    tokens = F.size(F.split("masked", " "))
    return (rows.filter("masked != ''")
            .select("id", "masked", F.xxhash64(tokens, F.substring_index("masked", " ", depth)).alias("leaf"), F.xxhash64("masked").alias("line")))


def recurring_lines(docs: DataFrame, **options) -> DataFrame:
    """Masked lines (``line``: hash, ``template``, ``n_docs``) whose template recurs."""
    return _recurring(docs, **options)[1]


def _recurring(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 3,
               max_children: int = 8, min_docs: int = 10, min_fixed: float = 0.5,
               groups: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, line) of the lines that may recur, and the masked lines that do; ``groups`` (id, component) names documents that count as one."""
    lines = _lines(docs, id_col, text_col, depth)
    # a line of a template is in its leaf: a leaf in fewer documents holds no recurring template
    leaves = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("of")).filter(F.col("of") >= min_docs)
    # as a table of known size, so that Spark can join it without a shuffle of the lines as long as it is small
    near = cut(lines.join(written(leaves, "line-leaves"), "leaf"))
    masked = near.groupBy("leaf", "line").agg(F.first("masked").alias("masked"), F.first("of").alias("of"), F.count(F.lit(1)).alias("n"))
    tokens = masked.select("leaf", "of", "n", F.posexplode(F.split("masked", " ")).alias("pos", "token"))
    common = F.col("n") * max_children >= F.col("of")
    # the tokens that each position keeps, in order of the positions; leaves without a rare token have no fields
    kept = (tokens.groupBy("leaf", "of", "pos", "token").agg(F.sum("n").alias("n"))
            .groupBy("leaf", "pos").agg(F.collect_list(F.when(common, F.col("token"))).alias("kept"), F.max(~common).alias("rare"))
            .groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("pos", "kept")))["kept"].alias("kept"), F.max("rare").alias("rare"))
            .filter("rare").drop("rare"))
    words = F.split("masked", " ")
    general = F.transform(words, lambda t, i: F.when(F.array_contains(F.get("kept", i), t), t).otherwise(F.lit(_FIELD)))
    known = masked.join(kept, "leaf", "left").select("line", "masked", "n", F.when(F.col("kept").isNotNull(), general).alias("general"))
    fixed = lambda x: F.size(F.filter(x, lambda t: t != _FIELD))
    size, after = F.size(words), F.slice("general", depth + 1, 1 << 30)
    template = F.array_join("general", " ")
    # a masked line in fewer rows than that is in fewer documents too
    whole = F.when((F.col("n") >= min_docs) & (fixed(words) >= min_fixed * size), F.col("masked"))
    wide = F.when((template != F.col("masked")) & (fixed("general") >= min_fixed * size) & (fixed(after) >= min_fixed * F.size(after)), template)
    known = known.select("line", F.explode(F.filter(F.array(whole, wide), lambda x: x.isNotNull())).alias("template"))
    known = cut(known.withColumn("key", F.xxhash64("template")))
    seen = near.drop("leaf", "masked").join(known.select("line", "key"), "line")
    if groups is not None:
        seen = seen.join(groups, "id", "left").select("key", F.coalesce("component", "id").alias("id"))
    counts = (seen.select("key", "id").distinct()
              .groupBy("key").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= min_docs))
    return near.select("id", "line"), known.join(counts, "key").select("line", "template", "n_docs")


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the recurring lines taken out of their text, and ``n_dropped`` beside it as (row, n_dropped)."""
    near, found = _recurring(docs, id_col, text_col, **options)
    gone = near.join(found.select("line"), "line", "left_semi").groupBy("id").agg(F.collect_set("line").alias("gone")).hint("shuffle_hash")
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    joined = docs.select(row).join(gone, F.col(f"row.{id_col}").eqNullSafe(F.col("id")), "left").select("row", "gone")
    text = F.split(F.col(f"row.{text_col}"), "\n")
    kept = F.when(F.col("gone").isNull(), text).otherwise(F.filter(text, lambda x: ~F.array_contains("gone", F.xxhash64(_masked(x)))))
    joined = joined.select("row", kept.alias("kept"))
    new = F.when(F.size("kept") == F.size(text), F.col(f"row.{text_col}")).otherwise(F.array_join("kept", "\n"))
    return joined.select(F.col("row").withField(text_col, new).alias("row"),
                         F.coalesce(F.size(text), F.lit(0)).cast("long").alias("n_lines"),
                         F.coalesce(F.size(text) - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"))


#: Near copies: words of a shingle, least similarity, and bits that give a shingle its bin and a bin its band.
_SHINGLE, _SIMILAR, _BIN_BITS, _BAND_BITS = 5, 0.8, 7, 4


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component) of the documents that have near copies; component is the smallest id of a group.

    The least hash of a text's word shingles in each of 128 bins is its sketch. Documents with an equal band of four bins are
    compared with the first of them, and belong together if their sketches agree in 0.8 or more of their shingles.
    Expressions only; a document meets one other in each of its 16 bands, however many copies there are. Rows without an id or a word are left out.
    """
    plain = F.trim(F.regexp_replace(F.col(text_col), r"[\x09-\x0D\x20]+", " "))
    rows = docs.select(F.col(id_col).alias("id"), F.split(plain, " ").alias("words")).filter(F.col("id").isNotNull() & (F.element_at("words", 1) != ""))
    n = F.size("words")
    some = F.transform(F.arrays_zip(*[F.slice("words", k + 1, n - _SHINGLE + 1).alias(f"w{k}") for k in range(_SHINGLE)]),
                       lambda z: F.xxhash64(*[z[f"w{k}"] for k in range(_SHINGLE)]))
    hashes = F.when(n >= _SHINGLE, some).otherwise(F.array(F.xxhash64("words")))
    rows = rows.select("id", F.array_sort(hashes).alias("h"))
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - _BIN_BITS)
    least = F.filter("h", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get("h", i - 1))))
    sketches = rows.select("id", least.alias("sketch")).groupBy("id").agg(F.min("sketch").alias("sketch"))
    sketches = written(sketches, "line-sketches")
    # four of the eight bins of a band, so that one edit seldom spoils it
    band = lambda b: F.filter("sketch", lambda x: F.shiftrightunsigned(x, 63 - _BAND_BITS) == 2 * b)
    bands = F.filter(F.array(*[F.struct(F.lit(b).alias("b"), band(b).alias("x")) for b in range(1 << _BAND_BITS)]), lambda z: F.size(z["x"]) > 0)
    keys = sketches.select("id", F.explode(F.transform(bands, lambda z: F.xxhash64(z["b"], z["x"]))).alias("band"))
    first = keys.groupBy("band").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "first")
    met = keys.join(first, "band").filter("id != first").select("id", "first").distinct()
    both = (met.join(sketches, "id").join(sketches.select(F.col("id").alias("first"), F.col("sketch").alias("other")), "first"))
    alike = F.size(F.array_intersect("sketch", "other")) >= _SIMILAR * F.size(F.array_union("sketch", "other"))
    return components(both.filter(alike).select(F.col("first").alias("a"), F.col("id").alias("b"))).select(F.col("node").alias("id"), F.col("root").alias("component"))


def without_recurring_lines(docs: DataFrame) -> DataFrame:
    """The documents left with text, their recurring lines taken out; columns as given.

    A group of near copies (``near_copies``) counts once for a template, so that lines of a
    text that is only copied, with edits or without, stay whole in all of them, and a later
    stage can keep one.

    A null text stays; rows with one id count once; rows without an id count as one document; a document
    that loses every line goes, one without text from the start stays; an empty table gives no rows.
    """
    rows = drop_recurring_lines(docs, groups=near_copies(docs))
    rows = rows.filter((F.col("n_dropped") == 0) | (F.trim(F.regexp_replace("row.text", r"\s+", " ")) != ""))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_recurring_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("kept_sha256"))


_MASK = r"regexp_replace(trim(regexp_replace({x}, '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g')"

SQL = {"op9_line_templates": f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
raw AS (SELECT r, doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS p, unnest(string_split(text, chr(10))) AS line FROM t),
ln AS (SELECT r, doc_id, p, line, {_MASK.format(x='line')} AS m FROM raw),
u AS (SELECT DISTINCT r, doc_id, m, len(string_split(m, ' ')) AS k, string_split(m, ' ')[1:3] AS lead FROM ln WHERE m <> ''),
lf AS (SELECT k, lead, count(*) AS total FROM u GROUP BY ALL),
dm AS (SELECT k, lead, m, count(*) AS n FROM u GROUP BY ALL),
tok AS (SELECT k, lead, m, n, generate_subscripts(string_split(m, ' '), 1) AS p, unnest(string_split(m, ' ')) AS token FROM dm),
f AS (SELECT k, lead, p, token FROM tok JOIN lf USING (k, lead) GROUP BY k, lead, p, token, total HAVING sum(n) * 8 >= total),
tpl AS (SELECT tok.k, m, list(CASE WHEN f.token IS NULL THEN '<*>' ELSE tok.token END ORDER BY tok.p) AS w
        FROM tok LEFT JOIN f ON tok.k = f.k AND tok.lead = f.lead AND tok.p = f.p AND tok.token = f.token GROUP BY tok.k, tok.lead, m),
ok AS (SELECT m, array_to_string(w, ' ') AS template FROM tpl WHERE len([x FOR x IN w IF x <> '<*>']) >= 0.5 * k AND len([x FOR x IN w[4:] IF x <> '<*>']) >= 0.5 * (k - 3)
       UNION SELECT m, m FROM dm WHERE len([x FOR x IN string_split(m, ' ') IF x <> '<*>']) >= 0.5 * k),
rec AS (SELECT template FROM u JOIN ok USING (m) GROUP BY template HAVING count(DISTINCT doc_id) >= 10),
gone AS (SELECT DISTINCT m FROM ok JOIN rec USING (template)),
k AS (SELECT r, count(*) AS n_lines, count(gone.m) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE gone.m IS NULL), '') AS kept
      FROM ln LEFT JOIN gone ON ln.m = gone.m GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN k USING (r)"""}
