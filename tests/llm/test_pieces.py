"""Encoding by backtracking against the sentencepiece library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tallyfold.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
POOLS = [" ", " \t\n\r", "abcdefghij ", "éüßñçøæ abc", "日本語漢字かなカナ ", "😀👍🏽‍👩 ", "▁ ▁", "\x00\x01\x7f �", "0123456789.,;:!?()[]{}<>/\\|@#$%^&*-_=+`~'\" ", "<0x41></s><unk><s>", "аяёжю ", "한국어 ", "ท่าน ไทย"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def random_texts(n):
    rng = random.Random(7)
    for _ in range(n):
        pool = rng.choice(POOLS) if rng.random() < 0.6 else "".join(POOLS)
        yield "".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) + " " * rng.choice([0, 0, 0, rng.randint(1, 70)])


def test_ids_and_texts_are_the_librarys(library):
    model = pieces.model(PATH)
    for text in [*random_texts(4000), "a" * 50_000, " " * 30_000, "ab" * 30_000, "日本" * 20_000]:
        ids = np.frombuffer(model.encode(text), "<i4").tolist()
        assert ids == library.encode(text)
        assert model.decode(ids) == library.decode(ids)


def test_any_ids_decode_as_in_the_library(library):
    model, rng = pieces.model(PATH), random.Random(8)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(262), rng.randrange(3, 259)]) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids)
    with pytest.raises(ValueError):
        model.decode([32_000])


def test_borders_are_checked_by_merging_and_places_fail():
    model = pieces.Model(PATH)
    text = "▁unbelievabilities"
    tokens = model.backtracked(text)
    assert "".join(tokens) == text and tokens == model.remerged(text)
    assert all(model.compatible(a, b) for a, b in zip(tokens, tokens[1:], strict=False))
    assert not model.compatible("▁", "t") and model.beside[("▁", "t")] is False  # they merge
    greedy = [w for w in ("▁thero", "▁interestate", "▁ofthe", "▁whereas", "▁overthere") if not model.remerged(w)[0].startswith(max((t for t in model.tokens if w.startswith(t)), key=len))]
    assert greedy, "no text here needs a token to be taken back or shortened"
    assert all(model.backtracked(w) == model.remerged(w) for w in greedy)


def test_models_of_other_kinds_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    (tmp_path / "unigram.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        pieces.Model(str(tmp_path / "unigram.model"))


def test_tables(spark, library):
    texts = [None, "", " ", "plain words", "plain words", "x" * 200_000 + " end", "a\nb\t日本 😀", *random_texts(100)]
    rows = [(i % 60 if i % 7 else None, t, "d", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids int").repartition(3)
    found = pieces.decoded(pieces.encoded(docs, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in found) == sorted((str(i), library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in pieces.round_trip(docs, PATH).collect()) == sorted((str(r.doc_id), r.ids, r.decoded) for r in found)
    assert pieces.decoded(pieces.encoded(docs.limit(0), PATH), PATH).count() == 0 == pieces.round_trip(docs.limit(0), PATH).count()
    assert pieces.decoded(spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>"), PATH).orderBy("k").collect() == [(1, None, ""), (2, [], "")]
