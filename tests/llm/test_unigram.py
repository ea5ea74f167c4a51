import random

import pytest

from ticklake.llm.unigram import DEFAULT_MODEL, MARK, DoubleArray, UnigramModel, decode, encode, op4_unigram

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return UnigramModel.load()


def test_double_array_finds_every_prefix():
    import numpy as np

    rng = random.Random(2)
    keys = {bytes(rng.choice(b"abcde\xc3") for _ in range(rng.randint(1, 6))) for _ in range(400)}
    ids = {k: i for i, k in enumerate(sorted(keys))}
    trie = DoubleArray.build(ids)
    text = bytes(rng.choice(b"abcdef\xc3") for _ in range(500))
    raw = np.frombuffer(text, np.uint8).astype(np.int32)
    starts = np.arange(len(text))
    a, b, v = trie.matches(raw, starts, np.full(len(text), len(text)))
    want = {(i, j, ids[text[i:j]]) for i in range(len(text)) for j in range(i + 1, min(len(text), i + 6) + 1) if text[i:j] in ids}
    assert set(zip(a.tolist(), b.tolist(), v.tolist())) == want


def plain(model, part):
    """Best score over all segmentations of an escaped part, character by character."""
    pieces = {t: s for t, s in zip(model.text, model.score) if t}
    best = [0.0] + [float("-inf")] * len(part)
    for i in range(len(part)):
        for j in range(i + 1, min(len(part), i + 50) + 1):
            s = pieces.get(part[i:j])
            if s is None and j == i + 1:
                s = model.unknown
            if s is not None:
                best[j] = max(best[j], best[i] + s)
    return best[-1]


@pytest.mark.parametrize("scores", ["zipf", "file"])
def test_segmentation_is_optimal(scores):
    model = UnigramModel.load(scores=scores)
    rng = random.Random(4)
    words = ["thndtionhe", "éeauouon", "ungzuü", "日本語x", "a" * 90, "token_=\"04db\"", "ﬁ№☃", "x" * 3]
    for w in words + ["".join(rng.choice("etaoinshr éü☃") for _ in range(30)) for _ in range(60)]:
        [ids] = model.encode([w])
        escaped = MARK + w.replace(" ", MARK)
        got, raw = 0.0, b""
        for i in ids:
            if i in model.byte_of:
                raw += bytes((model.byte_of[i],))
            else:
                got += model.score[i]
        got += model.unknown * len(raw.decode("utf-8"))
        assert abs(got - plain(model, escaped)) < 1e-6, w


def test_long_parts_are_optimal_at_any_window(monkeypatch):
    """Windows that cut pieces and characters, against the plain recursion and the step-wise search."""
    from ticklake.llm import unigram

    rng = random.Random(8)
    words = ["".join(rng.choice(f"etaoinshréü☃日本\U0001F600{MARK}x") for _ in range(rng.randint(70, 900))) for _ in range(12)] + ["a" * 700, MARK * 200]
    want = [UnigramModel.load()._viterbi([(MARK + w).replace(MARK, "\0").encode()])[0].tolist() for w in words]
    for window in (1, 7, 64, 1 << 16):
        monkeypatch.setattr(unigram, "_WINDOW", window)
        model = UnigramModel.load()
        assert [model._long((MARK + w).replace(MARK, "\0").encode())[0].tolist() for w in words] == want
        assert [model.decode(x) for x in model.encode(words)] == words
    for w in words[:4]:
        w = w.replace(MARK, "y")
        [ids] = model.encode([w])
        raw = bytes(model.byte_of[i] for i in ids if i in model.byte_of)
        got = sum(model.score[i] for i in ids if i not in model.byte_of) + model.unknown * len(raw.decode())
        assert abs(got - plain(model, MARK + w)) < 1e-6


def test_same_pieces_as_the_public_library(tmp_path):
    """The library's own unigram encoder with the same pieces and scores."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece

    model = UnigramModel.load()
    proto = pb.ModelProto()
    with open(DEFAULT_MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for i, p in enumerate(proto.pieces):
        if model.text[i]:
            p.score = float(model.score[i])
    other = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["Hello world, this is a test.", "Entreeau ére  vi équeeux", "ungzuü ☃ 日本", "of the and a", "x\ny\tz"]
    assert model.encode(texts) == other.encode(texts)


def test_query_round_trip_on_every_document(spark):
    out = op4_unigram(spark, SF).toPandas()
    assert out["round_trip"].all() and (out["n_pieces"] == out["ids"].map(len)).all() and len(out) == 200


def test_defined_cases(spark, model):
    texts = [None, "", " ", "  a  b ", f"x{MARK}y {MARK}\ufdd0", "a\n\n b\t", "☃\U0001F600", "k" * 120_000, "word " * 50_000, "dup", "dup"]
    docs = spark.createDataFrame(list(enumerate(texts)), "ids_ int, text string")
    rows = decode(encode(docs, model), model).orderBy("ids_").collect()
    assert [r["decoded"] for r in rows] == texts and rows[0]["ids"] is None and rows[1]["ids"] == []
    assert encode(docs.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        UnigramModel.load(scores="best")
