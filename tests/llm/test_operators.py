"""The corpus operators against plain versions of themselves, on small tables with nulls, empty texts, ties, copies and odd columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tallyfold.llm import counts, decontamination, language, packing, pages, pii, quality, repeats, rules, simhash
from tallyfold.llm.tokens import encoder

TOKENIZER, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, text string, text_key string, __text_key int, fp string, hash string"


def words(rng, n, stem="w"):
    return " ".join(f"{stem}{rng.randint(0, 4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [words(rng, 60) for _ in range(12)]
    near = [b.replace(" ", "  ", 1) for b in base[:4]] + [b + " tail" for b in base[4:8]]
    return [*base, *near, base[0], base[0], "", None, "one", "two words", "\n \t", "x" * 30_000, words(rng, 9000)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "k", 1, "f", None) for i, t in enumerate(texts)]
    rows += [(None, texts[1], None, None, None, None), (3, texts[3], "k", 1, "f", None), (3, "another text of doc three", "k", 1, "f", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# --- SimHash


def plain_fingerprint(text):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + 3]), 42) for i in range(max(1, len(ws) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(keys, linked):
    parent = list(range(len(keys)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(keys)), 2):
        if linked(keys[i], keys[j]):
            parent[top(j)] = top(i)
    return [top(i) for i in range(len(keys))]


def test_simhash_equals_plain(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    source = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    assert sorted((-1 if a is None else a, b) for a, b in source) == sorted((-1 if r.doc_id is None else r.doc_id, r.fp % (1 << 64)) for r in rows)
    top = groups([f for _, f in source], lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for (i, _), t in zip(source, top, strict=True):
        least[t] += [i] if i is not None else []
    want = sorted((-1 if i is None else i, min(least[t])) for (i, _), t in zip(source, top, strict=True))
    assert want == sorted((-1 if r.doc_id is None else r.doc_id, r.component_id) for r in rows)
    assert simhash.near_duplicates(none).count() == 0


def test_keep_one_keeps_one_row_of_each_group(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    top = groups([plain_fingerprint(r.text) for r in docs.collect()], lambda a, b: (a ^ b).bit_count() <= 2)
    assert len(rows) == len(set(top))
    assert len({plain_fingerprint(r.text) for r in rows}) == len(rows)
    assert simhash.keep_one(none).count() == 0


def test_links_of_a_crowded_list(spark):
    rng = np.random.default_rng(0)
    base = int(rng.integers(0, 2**63))
    values = {base}
    for _ in range(260):
        v = base
        for b in rng.integers(0, 64, 3):
            v ^= 1 << int(b)
        values.add(v ^ (int(rng.integers(0, 2**10)) << 8))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = [tuple(sorted(r)) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()]
    want = {tuple(sorted((a, b))) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert sorted(found) == sorted(want)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(8, 40)] + [(3, 3)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 40)}}


# --- packing and tokens


def test_encoder_gives_the_ids_of_the_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    encode, rng = encoder(TOKENIZER, PATTERN), random.Random(1)
    tests = ["", " ", "  ", "a  b", "x \ny", "x\n y", "\r\n", "don't we'll 12 34 ?!", "é à b 　c", "<|endoftext|> x"]
    tests += ["".join(rng.choice("ab \n\t.1é' ") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    assert [x.ids for x in t.encode_batch(tests, add_special_tokens=False)] == [encode(x).tolist() for x in tests]


def test_packing_keeps_every_id_once(docs, none):
    rows = packing.pack(packing.pieces(docs, TOKENIZER, PATTERN, capacity=64, with_ids=True), capacity=64, stream_pieces=50).collect()
    encode, sequences, found = encoder(TOKENIZER, PATTERN), defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == r.length <= 64 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences[r.sequence_id].append((r.offset, r.length))
        found[r.doc_id].append(r)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    for r in docs.where("doc_id is not null and doc_id <> 3").collect():
        parts = sorted(found[r.doc_id], key=lambda x: x.piece)
        want = [*encode(r.text or "").tolist(), 2]
        assert [x for p in parts for x in p.ids] == want and [p.piece for p in parts] == list(range(len(parts)))
        assert all(p.length == 64 for p in parts[1:]) and parts[0].start == 0
    assert packing.pack(packing.pieces(none, TOKENIZER, PATTERN)).count() == 0


def test_open_bins_close_the_fullest_and_fit_best():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    bins = packing.OpenBins(10, 1)
    assert bins.put(6) == (0, 0) and bins.put(9) == (1, 0)  # bin 0, the fullest open, closes
    assert bins.put(1) == (1, 9) and bins.put(4) == (2, 0)


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_token_counts(docs, none, block):
    source = docs if block > 7 else docs.where("length(text) < 600 or text is null")
    rows = counts.documents_of(*counts.flat_files(source, TOKENIZER, PATTERN), block=block).collect()
    encode = encoder(TOKENIZER, PATTERN)
    want = Counter((r.doc_id, len(encode(r.text or ""))) for r in source.collect())
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == want and all(r.closed for r in rows)
    assert counts.documents_of(*counts.flat_files(none, TOKENIZER, PATTERN)).count() == 0


def test_ids_after_the_last_end_id_are_an_open_document(spark, tmp_path):
    np.array([5, 6, counts.END_ID, 7, counts.END_ID, counts.END_ID, 8, 9], "<u2").tofile(tmp_path / "a")
    files = spark.createDataFrame([("a", 16)], "name string, bytes long")
    for block in (1, 3, 100):
        rows = counts.documents_of(f"file://{tmp_path}", files, with_header=False, block=block).orderBy("start").collect()
        assert [(r.start, r.n_tokens, r.closed) for r in rows] == [(0, 2, True), (3, 1, True), (5, 0, True), (6, 2, False)]


# --- decontamination


def test_containment_equals_plain(spark, none):
    rng = random.Random(5)
    items = [(i, words(rng, rng.randint(3, 40), "b")) for i in range(30)] + [(2, words(rng, 20, "b")), (None, words(rng, 12, "b")), (50, None), (51, "")]
    docs = [(0, None), (1, ""), (2, "short one")]
    for i in range(3, 60):
        parts = [words(rng, rng.randint(0, 400))]
        for _ in range(rng.randint(0, 2)):
            own = (rng.choice(items)[1] or "").split()
            if own:
                at = rng.randrange(len(own))
                if rng.random() < 0.5:
                    own[at] = "changed"
                parts.append(" ".join(own).upper() if rng.random() < 0.3 else ", ".join(own))
        docs.append((i, "\n".join(parts)))
    docs += [(5, docs[7][1]), (None, items[0][1] + " more")]

    def sh(t):
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    want = Counter()
    for d, t in docs:
        for i, x in items:
            if sh(x) and len(sh(x) & sh(t)) >= 0.8 * len(sh(x)):
                want[d, i, len(sh(x)), len(sh(x) & sh(t))] = 1
    table, probes = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, text_key int"), spark.createDataFrame([(*x, 9) for x in items], "item_id long, text string, doc_id int")
    got = Counter((r.doc_id, r.item_id, r.item_shingles, r.shared) for r in decontamination.contained(table, probes).drop("text_key").distinct().collect())
    assert got == want and len(want) > 5
    bad = {d for d, t in docs if any(sh(x) and len(sh(x) & sh(t)) >= 0.8 * len(sh(x)) for _, x in items)}
    assert bad
    clean = decontamination.clean(table, probes)
    assert clean.columns == table.columns
    assert sorted((r.doc_id, r.text or "") for r in clean.collect() if r.doc_id is not None) == sorted((d, t or "") for d, t in docs if d is not None and not any(sh(x) and len(sh(x) & sh(t)) >= 0.8 * len(sh(x)) for _, x in items))
    assert decontamination.contained(none, probes).count() == 0 and decontamination.clean(table, probes.limit(0)).count() == len(docs)


# --- personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum((2 * int(c) - 9 * (c > "4")) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 16 <= len(d) <= 19 and luhn, "phone": 8 <= len(d) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_plain():
    rng = random.Random(2)
    for _ in range(8000):
        alphabet = rng.choice(["a.@-1 ", "0123456789. -+()", "+1 23.", "@a.", "0. 1+-@b", "4 5-9"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 50)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("card 4539 1488 0343 6467.") == [("card", 5, 24)]
    assert pii.base_spans("a" * 200_000 + "@" + "1" * 200_000) == []  # linear


def test_terms_that_disclose_an_entity_are_found_and_cut(spark, none):
    rng = random.Random(8)
    rows = [(i, f"{words(rng, 12)} kestrel joe@example.org {words(rng, 12)}") for i in range(6)]
    rows += [(i, f"{words(rng, 30)} the sum {words(rng, 3)}") for i in range(6, 200)]
    rows += [(300 + i, f"hapaxterm +49 (30) 1234567 {words(random.Random(1), 5)}") for i in range(5)] + [(400, None), (401, "")]  # copies prove nothing
    docs = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n_chars long, base string")
    found = {r.doc_id: r for r in pii.found_spans(docs).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        spans = plain_spans(text or "")
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert found[i].base == base and found[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and found[i].n_phone == sum(k == "phone" for k, _, _ in spans)
        assert [text[x.start : x.end] for x in found[i].added or []] == (["kestrel"] if i < 6 else [])
    out = {r.doc_id: r for r in pii.sanitised(docs).collect()}
    assert pii.sanitised(docs).columns == docs.columns and out[400].text is None and out[401].text == "" and out[100].text == rows[100][1]
    assert all("kestrel" not in out[i].text and "[EMAIL]" in out[i].text and out[i].n_chars == len(out[i].text) for i in range(6))
    assert "[PHONE]" in out[300].text and "hapaxterm" in out[300].text
    assert pii.found_spans(none).count() == 0 and pii.sanitised(none).count() == 0


# --- repeated strings


def plain_repeats(data, length):
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "gram", "group", "alphabet"), [(12, 4, 2000, "ab"), (12, 4, 2, "ab"), (16, 8, 2000, "abcdeé "), (16, 16, 3, "abc")])
def test_repeats_equal_plain(spark, none, monkeypatch, length, gram, group, alphabet):
    monkeypatch.setattr(repeats, "CHUNK", 500)
    rng = random.Random(length + gram)
    base, data = "".join(rng.choice(alphabet) for _ in range(400)), ["", "short"]
    for _ in range(70):
        text = ""
        for _ in range(rng.randint(0, 5)):
            at, pick = rng.randint(0, 380), rng.random()
            text += base[at : at + rng.randint(1, 60)] if pick < 0.5 else rng.choice(alphabet) * rng.randint(1, 40) if pick < 0.6 else "".join(rng.choice("uvwxyz0123456789") for _ in range(30))
        data.append(text)
    data += data[5:8] + [base * 2]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(data)] + [(None, None, 0)], "doc_id long, text string, gram int").repartition(3)
    got = sorted(tuple(r) for r in repeats.deduplicated(docs, length, gram, group=group).collect() if r.doc_id is not None)
    assert got == [(i, *x) for i, x in enumerate(plain_repeats([t.encode() for t in data], length))]
    assert repeats.deduplicated(none, length, gram).count() == 0


# --- pages

PAGE = """<html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><header>Site name</header><nav><a href=x>Home</a></nav>
<div id="cookie-notice">We use cookies</div><main><article class="post"><header><h1>Title &amp; more</h1></header><p>First   para<p>Second <i>it</i>alic<br>line
<ul><li>one<li>two</ul><form><label>mail</label></form><aside>side words</aside><script>if (a<b) x("</p>")</script><p hidden>gone</p><p>Third &#233;t&eacute;.</p>
<section id=comments><article class="comment"><p>a reader's comment that is much longer than all of the text above it, by far, and then some more</p></article></section>
</article></main><div class="sidebar"><p>aa bb cc</p></div><footer>&copy; foot</footer>"""


def test_page_texts(spark):
    weights = pages.weights_of(dict(pages.label_counts(PAGE.replace('<article class="comment">', "<div>").replace("<main>", ""))))
    assert all(w < 0 for k, w in weights.items() if k not in pages.FIXED_WEIGHTS) and weights["word"] > 0
    want = "Title & more First para Second italic line one two Third été."
    plain = "<body><div class=menu><a>Home</a></div><div><h2>Head</h2><p>The text of a page without an article, long enough to count.</p></div><div class=ad>Buy</div>"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", "just words"), (4, "x", "<p>open <b x='"), (5, "y", "<" * 3000), (6, "z", "<nav>menu</nav>"), (7, "a", plain), (8, "b", "<a \"" * 5000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    for w in (weights, pages.fitted(table), dict(pages.FIXED_WEIGHTS)):
        got = sorted((r.page_id or 0, r.text, r.n_chars) for r in pages.extracted(table, w).collect())
        assert [x[1] for x in got[:7]] == ["", want, want, "", "just words", "open <b x='", "<" * 3000] and got[7][1] == ""
        assert got[8][1] == "Head The text of a page without an article, long enough to count."
        assert all(n == len(t) for _, t, n in got) and len(got) == len(rows)
    assert pages.extracted(table.limit(0), pages.fitted(table.limit(0))).count() == 0


def test_best_region_equals_plain():
    rng = random.Random(4)
    names = ["p", "div", "b", "/p"]
    weights = {"word": 1.0, "link word": 0.1, "p": -2.0, "div": -5.0, "b": -0.5, "/p": -0.1, "part": -3.0}

    def score(t):
        return weights["word"] * t[1] if t[0] == "text" else weights["link word"] * t[1] if t[0] == "link" else weights["part"] if t[0] == "part" else weights[t[2]]

    for _ in range(300):
        found = [rng.choice([("text", rng.randint(0, 6), "x"), ("link", 1, "x"), ("part", 0, ""), ("tag", 0, rng.choice(names))]) for _ in range(rng.randint(0, 25))]
        best = max([0.0, *(sum(map(score, found[a:b])) for a in range(len(found)) for b in range(a + 1, len(found) + 1))])
        a, b = pages.region(found, weights)
        assert abs(sum(map(score, found[a:b])) - best) < 1e-9


# --- language


def test_languages_are_told_apart_and_costs_are_exact(spark):
    rng = random.Random(6)
    parts = {"aa": ["ba", "bo", "li", "na", "é"], "bb": ["kru", "shk", "ost", "vy", "ch"]}
    rows = []
    for i in range(400):
        lang = rng.choice(["aa", "bb"])
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(30)), lang if i % 7 else None, lang))
    rows += [(900, None, "aa", ""), (901, "", "aa", ""), (902, "123 !", "aa", ""), (None, "kruost vych", None, "bb"), (1, rows[1][1], None, rows[1][3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")
    out = language.identified(docs).collect()
    assert len(out) == len(rows)
    truth = {r[0]: r[3] for r in rows}
    for r in out:
        assert r.lang_pred == (truth[r.doc_id] or "und") and 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert {r.lang_pred for r in language.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identified(docs.limit(0)).count() == 0


def test_code_lengths_equal_plain_partial_matching():
    train = [("x", b"abracadabra abra"), ("y", b"barbara cadabra")]
    rows = Counter()
    for lang, text in train:
        code, _ = language.grams([text])
        rows.update((lang, int(c)) for c in code)
    trees = language.grown(sorted((k, c, n) for (k, c), n in rows.items()))
    alphabet = sorted({b for _, t in train for b in t})

    def cost(lang, context, byte):
        own = [(c.to_bytes(4, "big"), n) for (k, c), n in rows.items() if k == lang]
        size, total = len(alphabet) + 1, 0.0
        for depth in (3, 2, 1, 0):
            after = Counter()
            for g, n in own:
                if g[3 - depth : 3] == context[3 - depth :]:
                    after[g[3]] += n
            if after:
                d, n = len(after), sum(after.values())
                if byte in after:
                    return total - np.log2(after[byte] / (n + d))
                total -= np.log2(d / (n + d))
        return total + np.log2(size)

    for text in (b"abra", b"cadb", b"zq a", b"b"):
        padded = b"\0\0\0" + text
        # contexts with bytes of no symbol share symbol 0
        norm = bytes(b if b in alphabet else 0 for b in padded)
        want = [sum(cost(lang, norm[i : i + 3], norm[i + 3]) for i in range(len(text))) for lang in ("x", "y")]
        assert np.allclose(language.code_lengths(trees, [text])[0], want, atol=1e-3)


# --- quality rules and classifier


def plain_repeated(ws):
    seen = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    hit = {j for i in range(len(ws) - 7) if seen[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(hit)


def test_statistics_equal_plain(spark, docs, none):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(["a", "b", " ", " ", "\n", "#", "é", "\t", " "]) for _ in range(rng.randint(0, 200)))) for i in range(150)]
    rows += [(1000, "x " * 40), (1001, None)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = Counter((r.doc_id, *r[1:6]) for r in rules.statistics(table).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect())
    want = Counter()
    for r in table.collect():
        text = r.text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = text.split("\n")
        dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
        want[r.doc_id, len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, plain_repeated(ws)] += 1
    assert got == want
    assert rules.judged(none, []).count() == 0


def test_rules_are_learned_and_applied_in_order(spark, none):
    rng = random.Random(10)
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        text = " ".join(w + "!!" for w in words(rng, 40).split()) if bad and i % 8 else "spam spam " * 30 if bad else words(rng, 50)
        rows.append((i, text, 1))
        labels.append((i, 0 if bad else 1, None))
    docs, graded = spark.createDataFrame(rows, "doc_id long, text string, rule int"), spark.createDataFrame([*labels, (None, 1, 1), (5, None, 1), (0, 0, 0)], "doc_id long, quality int, toxic int")
    learned = rules.fitted(docs, graded)
    assert 1 <= len(learned) <= 3
    out = {r.doc_id: r.rule for r in rules.judged(docs, learned).collect()}
    assert all((out[i] == 0) == (q == 1) for i, q, _ in labels)
    assert rules.fitted(docs, graded.limit(0)) == [] and rules.fitted(none.select("doc_id", "text"), graded) == []
    assert {r.rule for r in rules.judged(docs, []).collect()} == {0}


def test_ordinal_grades(spark, none):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(900):
        q, t = rng.random() > 0.2, rng.random() < 0.2
        text = words(rng, 40) + (" scoundrel" if t else "") + ("" if q else " zz ###")
        rows.append((i, text, 0.5))
        labels.append((i, int(q), int(t)))
    rows += [(2000, None, 0.1), (2001, "", 0.1), (None, rows[0][1], 0.1)]
    docs, graded = spark.createDataFrame(rows, "doc_id long, text string, p_top double"), spark.createDataFrame([*labels, (3, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(quality.sample(docs, graded))
    assert model.thresholds == sorted(model.thresholds)
    out = {r.doc_id: r for r in quality.scored(docs.select("doc_id", "text"), model).collect()}
    assert len(out) == len(rows)
    wrong = sum(out[i].accepted != (q and not t) for i, q, t in labels)
    assert wrong <= 5
    means = [np.mean([out[i].expected_grade for i, q, t in labels if q + 1 - t == g]) for g in (0, 1, 2)]
    assert means[0] < means[1] < means[2]
    kept = quality.accepted(docs, graded)
    assert kept.columns == docs.columns and {r.p_top for r in kept.collect()} <= {0.5, 0.1}
    assert quality.accepted(docs, graded.limit(0)).count() == len(rows) and quality.scored(none.select("doc_id", "text"), model).count() == 0
    assert quality.fit([(1, b"")]) is None
