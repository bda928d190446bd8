"""The packing stage delivers the token ids themselves."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from tallyfold.llm.tokens import encoder


def test_sequences_hold_the_ids(spark, tmp_path):
    texts = ["one two three", "", None, "word " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = corpus_pipeline.packed(spark, docs, "").collect()
    encode = encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        ids = [np.frombuffer(r.ids, "<u2") for r in own]
        assert np.concatenate(ids).tolist() == [*encode(text or "").tolist(), 2]
        assert all(r.length == len(x) and r.ids_crc32 == zlib.crc32(x.astype("<u4").tobytes()) for r, x in zip(own, ids, strict=True))


def test_packing_while_encoding(spark):
    import numpy as np
    from tallyfold.llm import packing, queries

    rng = np.random.default_rng(2)
    texts = [None, "", *[" ".join(f"w{x}" for x in rng.integers(0, 900, int(n))) for n in rng.integers(1, 700, 300)]]
    docs = spark.createDataFrame([(i % 200 if i else None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, offset int").repartition(2)
    whole = packing.pack(packing.pieces(docs, queries.TOKENIZER, queries.public_tokenizers.PATTERN, 256), 256).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    for waiting, bins in ((30_000, 65_536), (50, 65_536), (7, 3)):
        rows = packing.packed(docs, queries.TOKENIZER, queries.public_tokenizers.PATTERN, 256, open_bins=bins, waiting=waiting).collect()
        assert sorted(tuple(str(r[c]) for c in key) for r in rows) == sorted(tuple(str(r[c]) for c in key) for r in whole)
        places = {}
        for r in rows:
            places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for p in places.values():
            assert [a for a, _ in sorted(p)] == [0, *np.cumsum([n for _, n in sorted(p)])[:-1].tolist()] and sum(n for _, n in p) <= 256
    best = -(-sum(r.length for r in whole) // 256)
    assert len({r.sequence_id for r in packing.packed(docs, queries.TOKENIZER, queries.public_tokenizers.PATTERN, 256).collect()}) <= 1.1 * best + 2
    assert packing.packed(docs.limit(0), queries.TOKENIZER, queries.public_tokenizers.PATTERN).count() == 0
