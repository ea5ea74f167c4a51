import itertools
import re
import time
import zlib

import numpy as np

from ticklake.llm import langid
from ticklake.llm.langid import identify, keep_identified, op8_language_id, train

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_fold(spark):
    out = op8_language_id(spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.index]
    assert list(out["held_out"]) == held and out["score"].between(0, 1).all()
    test = out[out["held_out"]]
    assert (test["lang_pred"] == docs.loc[test.index, "lang"]).mean() > 0.97


def model(spark):
    rows = [("the house and the garden are that with this there" , "en"), ("der die das und nicht mit haus garten schön", "de"),
            ("это дом и сад которые вместе", "ru")] * 5
    return train(spark.createDataFrame(rows, "text string, lang string"), switch=4.0)


def brute(scores, switch):
    n, k = scores.shape
    best, back = scores[0].copy(), []
    for t in range(1, n):
        came = [max(range(k), key=lambda i: (best[i] - switch * (i != j), i == j)) for j in range(k)]
        back.append(came)
        best = np.array([best[i] - switch * (i != j) for j, i in enumerate(came)]) + scores[t]
    path = [int(best.argmax())]
    for came in reversed(back):
        path.append(came[path[-1]])
    return path[::-1], best.max()


def test_viterbi_score_matches_plain_recursion(spark):
    m = model(spark)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50, n) for n in (1, 2, 7, 40, 40, 300, 3)]
    scores = -rng.exponential(3.0, (50, len(m.langs)))
    for d, path in zip(docs, m.paths(scores, docs)):
        _, want = brute(scores[d], m.switch)
        got = scores[d, path].sum() - m.switch * (np.diff(path) != 0).sum()
        assert abs(got - want) < 1e-9


def test_mixed_text_splits_into_spans_and_scripts_narrow(spark):
    m = model(spark)
    [(lang, score, spans)] = m.label(["the house and the garden nicht schön das haus und garten это дом"])
    assert [s[2] for s in spans] == ["en", "de", "ru"] and sum(s[1] for s in spans) == 13 and 0 < score < 1
    assert m.label(["вместе"])[0][0] == "ru"


def test_numbers_are_no_letters_and_unseen_grams_are_alike(spark):
    m = model(spark)
    assert [x[0] for x in m.label(["½ ² ①", "١٢٣ 45 _", "Ⅷ", "x½"])] == ["und", "und", m.label(["Ⅷ"])[0][0], m.label(["x"])[0][0]]
    assert m.label(["½ ² ①"])[0][1] == 0.0 and np.allclose(m.logp[-1], m.logp[-1, 0])


def test_words_are_the_runs_of_letters_of_any_code_point():
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for text in (points, "", "½", "ab½cd² e①_f g3h", "plain words, größe дом"):
        assert langid.words_of(text) == ["".join(g) for alpha, g in itertools.groupby(text, str.isalpha) if alpha]


def test_words_of_plain_text_cost_little_more_than_a_plain_pattern():
    def least(f):
        took = []
        for _ in range(5):
            began = time.process_time()
            f()
            took.append(time.process_time() - began)
        return min(took)

    text = "the house and the größere garten это дом и сад, 12 words " * 4000
    plain = least(lambda: re.findall(r"[^\W\d_]+", text))
    # a pattern that names each number character took 17 times the plain one
    assert least(lambda: langid.words_of(text)) < 5 * plain


def test_defined_cases(spark):
    long = "the house " * 60_000
    rows = [(1, None, "en"), (2, "", None), (3, "12 !!", "en"), (4, "the house and the garden", "en"), (4, "the house and the garden", "en"),
            (None, "der garten und das haus", "de"), (5, long, "en"), (6, "漢字漢字", None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, language string")
    m = model(spark)
    got = {(r["doc_id"], r["language"]): r for r in identify(docs, m, out="x").select("doc_id", "language", "x.*").collect()}
    assert [got[(i, l)]["lang"] for i, l in ((1, "en"), (2, None), (3, "en"))] == ["und"] * 3
    assert got[(4, "en")]["lang"] == got[(5, "en")]["lang"] == "en" and got[(None, "de")]["lang"] == "de"
    assert got[(6, None)]["lang"] in m.langs
    full = spark.createDataFrame([(*r, r[2]) for r in rows], "doc_id int, text string, language string, lang string")
    kept = keep_identified(full)
    assert kept.columns == full.columns and {r["doc_id"] for r in kept.collect()} <= {4, 5, 6, None}
    assert keep_identified(full.limit(0)).collect() == []
