import random

import numpy as np

import corpus_pipeline
from ticklake.llm.decontaminate import normalised_words
from ticklake.llm.langid import held_out, train
from ticklake.llm.line_templates import SQL
from ticklake.llm.simhash import simhash64
from ticklake.llm.unigram import UnigramModel

SF = "/root/testdata/sf0.001"


def groups(fps, ids):
    v = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 3
    label = np.array(ids)
    while True:
        new = np.where(near, label[None, :], 1 << 60).min(axis=1)
        if (new == label).all():
            return label
        label = new


def plain_copies(texts, ids):
    """The first id of each group of texts whose sets of five-word shingles are alike in 0.8 or more, linked in chains."""
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    label, again = list(ids), True
    while again:
        again = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if label[j] < label[i] and 10 * len(a & b) >= 8 * len(a | b) and any(a) and any(b):
                    label[i], again = label[j], True
    return label


def test_near_copies_by_expressions(spark):
    from ticklake.llm.line_templates import near_copies

    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghij", k=5)) for _ in range(400)]
    base = [" ".join(draw.choices(words, k=n)) for n in (60, 200, 200, 2000, 3)]
    rows = []
    for t in base:
        for _ in range(30):
            w = t.split()
            if len(w) > 100:
                w[draw.randrange(len(w))] = "edited" + "".join(draw.choices("klmno", k=4))
            rows.append((len(rows), " ".join(w)))
    rows += [(1000 + i, base[0] + "\n" + " ".join(draw.choices(words, k=150))) for i in range(30)] + [(2000, None), (2001, ""), (None, base[0]), (2002, " \t ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as h", "2 as words")
    got = {r["id"]: r["component"] for r in near_copies(docs).collect()}
    assert {i: got.get(i, i) for i in range(150)} == {i: i // 30 * 30 for i in range(150)} and not [i for i in got if i >= 1000]
    assert "Python" not in near_copies(docs)._jdf.queryExecution().executedPlan().toString() and near_copies(docs.limit(0)).collect() == []


def test_stages_against_plain_versions(spark):
    import duckdb

    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs = given
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        before, after = docs.toPandas().sort_values("doc_id"), out.toPandas()
        if name != "sentencepiece_encoding":
            assert out.columns == given.columns
        if name == "language_id":
            m = train(docs.filter(~held_out()))
            good = [i for i, x in zip(before["doc_id"], m.label(list(before["text"]))) if x[0] != "und" and x[1] >= 0.5]
            assert sorted(after["doc_id"]) == good and len(good) > 0.95 * len(before)
        elif name == "line_dedup":
            c = duckdb.connect()
            c.register("documents", before[["doc_id", "text"]])
            c.register("grouped", before[["doc_id"]].assign(component=plain_copies(before["text"], before["doc_id"])))
            sql = SQL["op9_line_templates"].replace("sha256(coalesce(kept, ''))", "coalesce(kept, '')")
            # near copies count once
            assert "FROM u JOIN ok USING (m) GROUP BY template HAVING count(DISTINCT doc_id)" in sql
            sql = sql.replace("FROM u JOIN ok USING (m) GROUP BY template HAVING count(DISTINCT doc_id)",
                              "FROM u JOIN ok USING (m) JOIN grouped USING (doc_id) GROUP BY template HAVING count(DISTINCT component)")
            want = {i: t for i, _, n, t in c.execute(sql).fetchall() if n == 0 or t.strip()}
            assert dict(zip(after["doc_id"], after["text"])) == want
        elif name == "simhash_near_dedup":
            label = groups([simhash64(t) for t in before["text"]], before["doc_id"])
            assert sorted(after["doc_id"]) == sorted(before["doc_id"][label == before["doc_id"].to_numpy()])
        elif name == "decontamination":
            items = [normalised_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            grams = {tuple(w[i:i + 10]) for w in items if w for i in range(max(1, len(w) - 9))}
            hit = lambda w: any(tuple(w[i:i + k]) in grams for k in {len(g) for g in grams} for i in range(len(w) - k + 1))
            assert sorted(after["doc_id"]) == [i for i, t in zip(before["doc_id"], before["text"]) if not hit(normalised_words(t))]
        else:
            want = dict(zip(before["doc_id"], UnigramModel.load().encode(list(before["text"]))))
            assert {i: list(x) for i, x in zip(after["doc_id"], after["ids"])} == want and after["round_trip"].all()
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SF).collect()) == sorted(want)


def test_stages_on_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words of a text", "en", "s", 5), (3, "the words of it " * 9, "en", "s", 5),
            (3, "the words of it " * 9, "en", "s", 5), (4, "w" * 100_000, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").selectExpr("*", "'k' as ids", "1 as fp", "'l' as line", "'h' as hits")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).collect()
        assert len(out) <= len(rows) and (name == "language_id" or out)
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_one_of_many_copies_stays(spark):
    own = ["a long look at rivers", "where herons fish at dawn", "and boats come home late"]
    rows = [(i, "\n".join(own)) for i in range(20)]
    rows += [(100 + i, f"{w} {w} stands here\nShare this page with friends") for i, w in enumerate("ash elm oak fir yew bay fig gum box sal ivy nut".split())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = corpus_pipeline.line_dedup(spark, docs, SF)
    text = {r["doc_id"]: r["text"] for r in lines.collect()}
    assert len(text) == 32 and not any("Share" in t for t in text.values())
    kept = corpus_pipeline.simhash_near_dedup(spark, lines, SF).filter("doc_id < 100").collect()
    assert [r["text"] for r in kept] == ["\n".join(own)]


def test_one_whole_text_of_many_near_copies_stays(spark):
    words = [f"{a}{b}" for a in ("riv", "stone", "cloud", "hav", "mor", "lent", "tas", "bir", "quo", "sel") for b in ("en", "ow", "ing", "ard", "ule", "ish", "ock", "ane", "olt", "ipe")]
    lines = [" ".join(words[(17 * i + 7 * k * k + k) % 100] for k in range(16)) for i in range(20)]
    rows = [(i, "\n".join(f"{x} {w}" if k == i % 20 else x for k, x in enumerate(lines))) for i, w in enumerate("ash elm oak fir yew bay fig gum box sal ivy nut".split())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fps = [simhash64(t) for _, t in rows]
    cleaned = corpus_pipeline.line_dedup(spark, docs, SF)
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == dict(rows)
    kept = corpus_pipeline.simhash_near_dedup(spark, cleaned, SF).collect()
    assert len(kept) == len(set(groups(fps, range(12)))) and all(len(r["text"].split("\n")) == 20 for r in kept)


def test_a_line_that_recurs_goes_at_any_size(spark):
    words = [f"w{chr(97 + i // 8)}{chr(97 + i % 8)}" for i in range(60)]
    for size in (20, 2000):
        rows = []
        for i in range(size):
            line = list(words)
            for k in (7, 11, 13) if i % 2 else ():  # other positions and other words in each variant
                line[3 + i * k % 57] = "v" + "".join(chr(97 + int(c)) for c in str(i * 20 + k))
            # documents of their own but for that line; near copies would count once
            draw = random.Random(i)
            own = [" ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(20)) for _ in range(6)]
            rows.append((i, "\n".join([*own, " ".join(line)])))
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        out = corpus_pipeline.line_dedup(spark, docs, SF).collect()
        assert len(out) == size and not [r for r in out if " ".join(words) in r["text"]]
