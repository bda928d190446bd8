"""Language models keep every gram and every byte."""

import numpy as np
from tallyfold.llm import language


def test_all_grams_and_bytes_are_kept(spark):
    rng = np.random.default_rng(4)
    hot = ["".join(chr(c) for c in rng.integers(33, 127, 40)) for _ in range(2500)]  # takes 94 symbols and more than 60,000 grams
    small = {"ru": "абвг", "el": "αβγδ"}
    rows = [(i, t, "hot") for i, t in enumerate(hot)]
    rows += [(5000 + 10 * k + i, " ".join(small[x][(i + j) % 4] * 3 for j in range(6)), x) for k, x in enumerate(small) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = language.trained(docs)
    every = {r.lang: r.grams for r in language.gram_counts(docs.where(~language.held_out())).groupBy("lang").agg({"gram": "count"}).withColumnRenamed("count(gram)", "grams").collect()}
    assert {x: len(trees.orders[i][3][0]) for i, x in enumerate(trees.langs)} == every and every["hot"] > 60_000
    assert all(trees.seen[b] for b in "αбγ".encode())
    found = {r.doc_id: r.lang_pred for r in language.identified(docs).collect()}
    assert all(found[i] == x for i, _, x in rows)


def test_deeply_nested_pages_are_read_in_linear_time():
    import time

    from tallyfold.llm import pages

    for unit, end in (("<div>", "</div>"), ("<ul><li>", "</li></ul>"), ("<p><b><i>", "")):
        times = []
        for n in (10_000, 40_000):
            start = time.perf_counter()
            assert pages.main_text(unit * n + "some words of text here " * 9 + end * n, pages.FIXED_WEIGHTS).startswith("some words")
            times.append(time.perf_counter() - start)
        assert times[1] < 12 * times[0] + 0.5  # square growth would be 16 times


def test_unknown_elements_share_one_weight():
    from tallyfold.llm import pages

    counts = pages.label_counts("<body><x-a>out</x-a><article><p>in words</p><x-b>more</x-b></article></body>")
    assert {k for k, _ in counts} == {"word", "body", "/body", "p", "/p", pages.OTHER_TAG}


def test_numbers_that_look_like_letters_are_none(spark):
    rows = [(i, "some plain words of a text", "en") for i in range(20)] + [(100 + i, t, None) for i, t in enumerate(("²", "½ Ⅷ 3", "12 _ -", "x²", "ª"))]
    found = {r.doc_id: r.lang_pred for r in language.identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect() if r.doc_id >= 100}
    assert found == {100: "und", 101: "und", 102: "und", 103: "en", 104: "en"}
