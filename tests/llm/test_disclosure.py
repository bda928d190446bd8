"""Terms that disclose an entity are found and cut wherever they stand in its documents."""

import random

from tallyfold.llm import pii


def words(rng, n):
    return " ".join(f"w{rng.randint(0, 4000)}" for _ in range(n))


def test_far_occurrences_are_cut(spark):
    rng = random.Random(4)
    rows = [(i, f"{words(rng, 10)} ann@example.org {words(rng, 25)} Kestrel {words(rng, 20)} kestrel {words(rng, 3)}") for i in range(6)]
    far = words(rng, 12)
    copies = [(20 + i, f"{far} bob@example.org {far} {words(random.Random(2), 12)} hapaxterm {'x' * i}") for i in range(6)]  # copies in another wrapping
    rows += [*copies, *[(100 + i, words(rng, 40)) for i in range(200)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert all("kestrel" not in out[i].lower() and "[EMAIL]" in out[i] for i in range(6))
    assert all("hapaxterm" in out[20 + i] for i in range(6)) and all(out[i] == t for i, t in rows if i >= 100)
    added = {r.doc_id: r.added for r in pii.found_spans(docs).collect()}
    assert all([t[x.start : x.end].lower() for x in added[i]] == ["kestrel"] * 2 for i, t in rows if i < 6)


def test_two_entities_and_a_repeated_row(spark):
    rng = random.Random(9)
    rows = [(i, f"osprey {words(rng, 30)} cat@example.org {words(rng, 20)} +49 (30) 1234567 {words(rng, 9)}") for i in range(8)]
    rows += [rows[0], (None, rows[1][1])] + [(100 + i, words(rng, 60)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = pii.sanitised(docs).collect()
    assert len(out) == len(rows) and not [r for r in out if "osprey" in r.text] and sum("[PHONE]" in r.text for r in out) == 10
