"""Divergence of sources against a plain version over all terms and pairs."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from tallyfold.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, value string, block int"


def plain(rows, min_docs=3, ranks=200):
    docs = [((lang or ""), (source or ""), [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= min_docs)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if seen[t] >= min_docs)
        whole = sum(counts.values(), Counter())

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = sorted((-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in counts if o != s)
            out |= {(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(pairs, 1)}
            terms = sorted((-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t])
            out |= {(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(terms[:ranks], 1)}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    word = lambda k: rng.choice(["Été", "naïve", "ÀB", "İX", "日本"]) if rng.random() < 0.1 else f"{'abcdefgh'[int(rng.paretovariate(0.7)) % 8]}{'xyzw'[k % 4]}{'q' * int(rng.paretovariate(1) % 9)}"
    out = [(" ".join(word(k) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "en", "de"]), f"s{int(rng.paretovariate(0.5)) % 7}") for k in range(150)]
    out += [(None, "en", "empty"), ("", None, None), ("only here", "fr", "a"), ("1 2 3", "fr", "b"), ("a b", None, "x"), ("hot " * 5000, "en", "s1"), out[0], out[0], ("MiXed-CASE x_y é", "de", None)]
    return out


def table(spark, rows):
    return spark.createDataFrame([(None if i % 9 == 0 else i % 20, *r, "t", 1, "v", 2) for i, r in enumerate(rows)], SCHEMA).repartition(3)


def test_audit_equals_the_plain_version(spark, rows):
    found = divergence.audit(table(spark, rows)).collect()
    assert {tuple(r) for r in found} == plain(rows) and len(found) == len(plain(rows))
    assert any(r.lang == "fr" and r.part == "pair" and r.value == 0 for r in found)  # no kept terms


def test_many_blocks_small_chunks_and_held_terms_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "LEAST", 1)
    monkeypatch.setattr(divergence, "A_PAIR", 1)
    monkeypatch.setattr(divergence, "HELD", 40)
    monkeypatch.setattr(divergence, "CHUNK", 7)
    assert {tuple(r) for r in divergence.audit(table(spark, rows), term_ranks=3).collect()} == plain(rows, ranks=3)


def test_empty_table(spark, rows):
    out = divergence.audit(table(spark, rows).limit(0))
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"] and out.count() == 0


def test_block_sums_equal_sums_over_dense_shares():
    rng = np.random.default_rng(3)
    n_terms, size = 300, 11
    dense = rng.integers(0, 40, (n_terms, size)) * (rng.random((n_terms, size)) < 0.3)
    dense[:, 4] = 0
    term, group = np.nonzero(dense)
    n, v = dense.sum(axis=0) + 17, 1000  # other blocks hold more
    p = np.array([[1 + 10**9 * (int(c) + 1) // (int(n[g]) + v) for g, c in enumerate(row)] for row in dense], object)
    want = [[sum((a - b) ** 2 // b for a, b in zip(p[:, i], p[:, j], strict=True)) for j in range(size)] for i in range(size)]
    mix = rng.permutation(len(term))
    assert divergence.block_divergence(term[mix], group[mix], dense[term, group][mix], n_terms, n, v).tolist() == want


def test_sql_equals_the_plain_version(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert set(con.execute(divergence.ORACLE).fetchall()) == plain(rows)
