"""The pipeline on a small corpus with planted cases, and the queries' contracts."""

import random
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from tallyfold.llm import queries
from tallyfold.llm.tokens import encoder


def words(rng, n):
    return " ".join(f"w{rng.randint(0, 9000)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng, folder = random.Random(1), str(tmp_path_factory.mktemp("corpus"))
    items = [(i, words(rng, 25)) for i in range(5)]
    good = [(i, words(rng, 60)) for i in range(300)]
    bad = [(1000 + i, words(rng, 60) + " scoundrel") for i in range(80)] + [(2000 + i, " ".join(w + "###" for w in words(rng, 50).split())) for i in range(80)]
    copies = [(3000 + i, good[i][1]) for i in range(10)] + [(2, good[2][1])]
    leaks = [(4000 + i, words(rng, 200) + " " + items[i][1] + " " + words(rng, 200)) for i in range(5)]
    mail = [(5000 + i, words(rng, 20) + f" u{i}@example.org " + words(rng, 20)) for i in range(5)]
    docs = [*good, *bad, *copies, *leaks, *mail, (6000, None), (6001, ""), (None, words(rng, 60))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, int(i < 2000), int(i < 2000)) for i, _ in bad], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(docs)


def test_each_stage_does_its_work(spark, corpus):
    folder, docs = corpus
    table = spark.read.parquet(f"{folder}/documents.parquet")
    columns, steps = table.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/out-{name}"
        stage(spark, table, folder).write.parquet(path)
        table = spark.read.parquet(path)
        steps[name] = table.collect()
        assert name == "packing" or table.columns == columns
    ids = {name: {r.doc_id for r in rows} for name, rows in steps.items()}
    assert not {i for i in ids["quality"] if i and 1000 <= i < 3000} and set(range(300)) <= ids["quality"]
    assert not {i for i in ids["near_duplicates"] if i and 3000 <= i < 4000} and set(range(300)) <= ids["near_duplicates"]
    assert Counter(r.doc_id for r in steps["near_duplicates"])[2] == 1 and None in ids["near_duplicates"]
    assert not {i for i in ids["decontamination"] if i and 4000 <= i < 5000} and set(range(300)) <= ids["decontamination"]
    clean = {r.doc_id: r.text for r in steps["personal_data"]}
    assert all("[EMAIL]" in clean[5000 + i] and "@" not in clean[5000 + i] for i in range(5)) and all(clean[i] == docs[i] for i in range(300))
    encode = encoder(queries.TOKENIZER, queries.public_tokenizers.PATTERN)
    total = Counter()
    for r in steps["packing"]:
        total[r.doc_id] += r.length
    assert total == Counter({i: len(encode(t or "")) + 1 for i, t in clean.items()})


def test_run_and_contract_columns(spark, corpus):
    folder, docs = corpus
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    rows, encode = out.collect(), encoder(queries.TOKENIZER, queries.public_tokenizers.PATTERN)
    bins = {}
    for r in rows:
        assert len(r.ids) == 2 * r.length and zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) == r.ids_crc32
        if r.doc_id is not None and r.doc_id < 300:
            assert (np.frombuffer(r.ids, "<u2") == np.append(encode(docs[r.doc_id]), 2)[r.start : r.start + r.length]).all()
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        ends = [0, *[a + n for a, n in sorted(places)]]
        assert ends[:-1] == [a for a, _ in sorted(places)] and ends[-1] <= 1024
    assert len(rows) > 300
    want = {
        "op1_benchmark_decontamination": "doc_id,item_id", "op4_pii_sanitisation": "doc_id,n_email,n_ip,n_card,n_phone,base_sha256,spans", "op5_suffix_dedup": "doc_id,n_bytes,n_removed,n_spans,kept_sha256",
        "op6_best_fit_packing": "doc_id,piece,start,length,ids_crc32,sequence_id,offset", "op7_simhash_near_dedup": "doc_id,fingerprint,component_id", "op8_language_identification": "doc_id,held_out,lang_pred,score",
        "op9_quality_rules": "doc_id,n_words,word_chars,n_symbols,n_dup_lines,n_repeat_words,base_failed,kept", "op2_ordinal_quality": "doc_id", "op10_token_counts": "doc_id",
        "op11_source_divergence": "lang,source,part,item,value,rank", "op12_sentencepiece_round_trip": "doc_id,n_tokens,ids_sha256,decoded_sha256",
    }
    rows = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name, columns in want.items():
        found = queries.QUERIES[name](spark, folder)
        assert set(columns.split(",")) <= set(found.columns)
        n = found.count()
        assert n == rows or name in ("op1_benchmark_decontamination", "op6_best_fit_packing") and n >= 5 or name == "op11_source_divergence" and n == 0  # one source
    assert {r.doc_id for r in queries.QUERIES["op1_benchmark_decontamination"](spark, folder).collect()} == {4000 + i for i in range(5)}
