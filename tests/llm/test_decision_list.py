import re
from collections import Counter

from ticklake.llm.decision_list import STATISTICS, Condition, Rule, decide, judge, learn, op6_decision_list, text_statistics

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            hit |= set(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_query_statistics_and_base_rules(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = op6_decision_list(spark, SF).collect()
    assert len(out) == len(docs)
    for r in out:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == brute(docs[r["doc_id"]])
        assert r["base_failed"] == (got[0] < 10 or 100 * got[4] > 20 * got[0])
        assert r["kept"] == (not r["base_failed"] and r["rule"] == 0)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r["kept"] for r in out if labels.get(r["doc_id"]) == 1]
    bad = [r["kept"] for r in out if labels.get(r["doc_id"]) == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.3 * len(bad)


def test_defined_cases(spark):
    texts = [None, "", "a b a b a b a b a b a", "x\n \nx\nx ", "one two three four five " * 3, "é " * 40_000, "|#|"]
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)] + [(None, "a b", "o"), (4, texts[4], "o")], "doc_id int, text string, words string")
    rows = [(r["doc_id"], *(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))) for r in text_statistics(docs).collect()]
    want = [(i, *brute(t)) for i, t in enumerate(texts)] + [(None, *brute("a b")), (4, *brute(texts[4]))]
    assert sorted(map(str, rows)) == sorted(map(str, want))
    none = spark.createDataFrame([], "doc_id int, quality int")
    got = judge(text_statistics(docs), none).collect()
    assert all(r["kept"] == (not r["base_failed"]) and r["rule"] == 0 for r in got)
    assert text_statistics(docs.limit(0)).collect() == []


def test_learns_an_ordered_list(spark):
    rows = [(i, int(i % 7 == 0 or i % 11 == 0), float(i % 7 == 0), float(i % 11 == 0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id int, bad int, symbol_share double, upper_share double")
    for s in STATISTICS:
        if s not in df.columns:
            df = df.selectExpr("*", f"cast(doc_id % 5 as double) as {s}")
    rules = learn(df)
    assert {r.conditions[0].statistic for r in rules} == {"symbol_share", "upper_share"} and len(rules) == 2
    wrong = df.withColumn("rule", decide(rules)).filter("(rule > 0) <> (bad = 1)").count()
    assert wrong == 0
    first = decide([Rule((Condition("symbol_share", 0.5, True),)), Rule((Condition("symbol_share", 2.0, False),))])
    assert {(r["symbol_share"], r["rule"]) for r in df.withColumn("rule", first).collect()} == {(1.0, 1), (0.0, 2)}


def labelled(spark, rows):
    df = spark.createDataFrame(rows, "doc_id int, bad int, distinct_share double, upper_share double")
    for s in STATISTICS:
        if s not in df.columns:
            df = df.selectExpr("*", f"cast(doc_id % 5 as double) as {s}")
    return df


def test_rare_kinds_and_long_lists(spark):
    # 12 bad rows in 4,000, below the first of 32 quantiles, and 12 above the last
    rare = labelled(spark, [(i, int(i < 24), 0.1 + i / 1e4 if i < 12 else 0.2 + i / 5e3, 2.0 + i / 1e4 if 12 <= i < 24 else i / 5e3) for i in range(4000)])
    assert rare.withColumn("rule", decide(learn(rare))).filter("(rule > 0) <> (bad = 1)").count() == 0
    # 14 kinds, each between good rows
    many = labelled(spark, [(i, int(i % 29 % 2), float(i % 29), 0.5) for i in range(2900)])
    rules = learn(many)
    assert len(rules) > 12 and many.withColumn("rule", decide(rules)).filter("(rule > 0) <> (bad = 1)").count() == 0
