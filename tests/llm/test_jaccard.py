"""Near-duplicates by exact Jaccard similarity against a plain version, with planted edited copies."""

import random

import corpus_pipeline
import numpy as np
import pytest
from tallyfold.llm import jaccard, simhash


def plain_shingles(text):
    ws = (text or "").lower().split()
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def linked(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def plain_groups(texts):
    sets, group = [plain_shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if group[i] != group[j] and linked(sets[i], sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    return group


def edited(rng, text, n):
    ws = text.split()
    for at in rng.sample(range(len(ws)), n):
        ws[at] = f"new{rng.randint(0, 9999)}"
    return " ".join(ws)


def corpus():
    rng = random.Random(11)
    base = [" ".join(f"w{rng.randint(0, 4000)}" for _ in range(rng.choice([40, 150, 400]))) for _ in range(60)]
    near = [edited(rng, b, max(1, len(b.split()) // 60)) for b in base[:40] for _ in range(2)]
    apart = [edited(rng, b, len(b.split()) // 12) for b in base[40:]]
    chain = [base[0]]
    for _ in range(6):  # neighbours are near, the ends are not
        chain.append(edited(rng, chain[-1], max(1, len(base[0].split()) // 60)))
    return [*base, *near, *apart, *chain, base[3].upper(), "", None, " \n", "one", "two words", "ONE"]


def test_groups_equal_plain(spark):
    texts = corpus()
    docs = spark.createDataFrame([(None if i % 41 == 7 else i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, place int").repartition(3)
    rows = jaccard.near_duplicates(docs).collect()
    assert len(rows) == len(texts)
    want = plain_groups(texts)
    named = {r.doc_id: r.component for r in rows if r.doc_id is not None}
    for i in named:
        for j in named:
            assert (named[i] == named[j]) == (want[i] == want[j])
    kept = corpus_pipeline.without_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and sorted(want[r.place] for r in kept.collect()) == sorted(set(want))
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_a_group_of_near_copies_is_one(spark):
    rng = random.Random(5)
    base = " ".join(f"w{rng.randint(0, 4000)}" for _ in range(200))
    texts = [base] + [edited(rng, base, 3) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect()} == {0}


def test_copies_that_only_their_source_links(spark):
    """Edited copies of one text: many are near the source alone, not near one another. It is the pivot that they meet."""
    rng = random.Random(9)
    base = " ".join(f"w{rng.randint(0, 4000)}" for _ in range(300))
    texts = [base] + [edited(rng, base, rng.randint(2, 12)) for _ in range(400)]
    want = plain_groups(texts)
    found = {r.doc_id: r.component for r in jaccard.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert all(want[i] == want[j] for i in found for j in found if found[i] == found[j])  # no false link
    lost = len(set(found.values())) - len(set(want))
    assert lost <= 0.01 * len(texts), lost


@pytest.mark.parametrize("piece", [1024, 7])
def test_all_pairs_of_a_bucket_count(spark, monkeypatch, piece):
    """One bucket for all texts: most near pairs hold neither a pivot nor its smallest content, nor does a chain by a pivot join them."""
    monkeypatch.setattr(jaccard, "band_keys", lambda hashes: [7] if len(hashes) else [])
    monkeypatch.setattr(jaccard, "PIECE", piece, raising=False)
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randint(0, 4000)}" for _ in range(rng.choice([60, 200, 210]))) for _ in range(40)]
    texts = [*base, *[edited(rng, b, 1) for b in base[:25]], *[edited(rng, b, len(b.split()) // 30) for b in base[10:]], "", None, base[0]]
    want = plain_groups(texts)
    for groups in (jaccard.near_duplicates, jaccard.near_copies):
        found = {r.doc_id: r.component for r in groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
        assert all((found[i] == found[j]) == (want[i] == want[j]) for i in found for j in found)


def test_parities_never_differ_more_than_sets():
    rng = np.random.default_rng(4)
    for n, new in ((1, 0), (1, 1), (40, 3), (400, 44), (3000, 2000)):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[new:], rng.integers(0, 1 << 63, new, dtype=np.uint64)]))
        bits = int(np.bitwise_count((jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b)) and (bits > 0 or not new)
    assert not jaccard.parities(np.zeros(0, np.uint64)).any()


def test_nothing_is_left_in_the_shared_folder_but_what_is_returned(spark, tmp_path):
    from pathlib import Path

    from tallyfold.llm.common import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    jaccard.near_duplicates(spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g"), (3, None)], "doc_id long, text string")).collect()
    assert {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before} == {"shingled", "roots"}


def test_close_fingerprints_link_in_the_pipeline(spark):
    """Words that come over and over: one more of a kind leaves the fingerprint alone, but not the set of five-word shingles."""
    loop = " ".join(["alpha beta gamma"] * 40)
    texts = [loop + " delta", loop + " epsilon", " ".join(f"w{i}" for i in range(60)), None, ""]
    sets = [plain_shingles(t) for t in texts]
    assert not linked(sets[0], sets[1])
    assert simhash.fingerprint(texts[0].encode()) == simhash.fingerprint(texts[1].encode())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect()} == {0, 2, 3}
    rows = jaccard.near_copies(docs).collect()
    own = {r.doc_id: r.component for r in rows}
    assert own[0] == own[1] and own[3] == own[4] and len(set(own.values())) == 3
    op7 = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert all((op7[i] == op7[j]) <= (own[i] == own[j]) for i in own for j in own)  # no link of the index is lost
