"""Information-theoretic sanitisation of personal data.

Base spans are e-mail addresses, IP addresses, card and phone numbers found by pattern. Their values are the protected entities. The
corpus then tells which terms disclose an entity: with N documents, df(t) documents that hold term t, df(e) that mention entity e and
df(t, e) that do both, anywhere in the document, the point-wise mutual information

    pmi(t, e) = log2(N * df(t, e) / (df(t) * df(e)))

is how many bits t tells about e, and ic(e) = log2(N / df(e)) is all there is to tell. A term is disclosing when pmi >= share * ic;
at ``REMOVE_SHARE`` it is removed, from ``GENERALISE_SHARE`` on it is generalised to its kind. In every document that mentions the
entity each occurrence outside of base spans is marked.

Chance alone puts rare words beside rare entities, so co-occurrence has to be significant: with n documents of e, k of them with t,
and a share p of all documents that hold t, chance does as much with a probability of at most 2 ** -(n * KL(k / n || p)), which must
not exceed ``ALPHA`` over all terms times all entities. Here documents whose mention of e stands among the same ``WINDOW`` words on
each side are copies and count once, so copies prove nothing. All documents count.

Null texts are empty: no spans, and a null text stays null when it is sanitised. Repeated rows count as often as they occur and get
the same spans; rows with the same doc_id and different texts are told apart. An empty table gives an empty result. Columns other
than doc_id and text are passed through or ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import only, saved, text_key, unused

KINDS = ("email", "ip", "card", "phone")
LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
WORD = re.compile(r"\w+")
#: Words on each side of a mention by which copies are known.
WINDOW = 8
#: Chance of any false term in the whole corpus.
ALPHA = 0.05
GENERALISE_SHARE = 0.8
REMOVE_SHARE = 0.95

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, each looked for around its @, so that long words cost no more than once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans by kind in the order of KINDS, then by start."""
    out = [("email", *s) for s in emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(value: str) -> int:
    return xxhash.xxh64_intdigest(value) - (1 << 63)


def contexts(text: str, spans: list[Span]) -> tuple[dict[int, int], list[tuple[int, int, int]]]:
    """For each entity the least hash of the words around its mentions; term, start and end of every word that no span covers."""
    words = [m.span() for m in WORD.finditer(text)]
    starts, ends = [a for a, _ in words], [b for _, b in words]
    covered = bytearray(len(words))
    mentions: dict[int, int] = {}
    for kind, a, b in spans:
        left, right = bisect_right(ends, a), bisect_left(starts, b)
        covered[left:right] = b"\1" * (right - left)
        entity = digest(f"{kind}:{NOT_DIGIT.sub('', text[a:b]) if kind in ('card', 'phone') else text[a:b].lower()}")
        near = (*range(max(0, left - WINDOW), left), *range(right, min(len(words), right + WINDOW)))
        context = digest("\0".join(text[starts[i] : ends[i]].lower() for i in near))
        mentions[entity] = min(context, mentions.get(entity, context))
    return mentions, [(digest(text[a:b].lower()), a, b) for (a, b), c in zip(words, covered, strict=True) if not c]


def scanned(docs: DataFrame) -> DataFrame:
    """A row per row of docs: doc_id, text_key, counts, base_sha256, base (spans as text), mentions and, if there are any, words."""
    names = {"mentions": ("entity", "context"), "words": ("term", "start", "end")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.list_(pa.struct([(n, pa.int64()) for n in x])) for x in names.values()]
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                counts = Counter(k for k, _, _ in spans)
                base = joined(spans)
                found, words = contexts(text, spans) if spans else ({}, [])
                lists = [[dict(zip(n, x, strict=True)) for x in v] for n, v in zip(names.values(), (found.items(), words), strict=True)]
                rows.append((*[counts[k] for k in KINDS], hashlib.sha256(base.encode()).hexdigest(), base, *lists))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            arrays = [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(c, pa.string()) for c in columns[4:6]] + [pa.array(c, t) for c, t in zip(columns[6:], types, strict=True)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_key"), *arrays], ["doc_id", "text_key", *[f"n_{k}" for k in KINDS], "base_sha256", "base", *names])

    lists = ", ".join(f"{n} array<struct<{', '.join(f'{x}: long' for x in fields)}>>" for n, fields in names.items())
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, {lists}"
    return only(docs, "doc_id", "text").withColumn("text_key", text_key(F.col("text"))).mapInArrow(run, schema)


def term_frequencies(docs: DataFrame) -> DataFrame:
    """term (hash), df: in how many rows of docs the term occurs; counted in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def drained() -> pa.RecordBatch:
            terms = np.fromiter((xxhash.xxh64_intdigest(t) for t in counts), np.uint64, len(counts)) - np.uint64(1 << 63)
            batch = pa.record_batch([pa.array(terms.view(np.int64)), pa.array(list(counts.values()), pa.int64())], ["term", "df"])
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    counts.update(set(WORD.findall(text.lower())))
                    if len(counts) > 500_000:
                        yield drained()
        yield drained()

    return only(docs, "text").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def disclosing_terms(found: DataFrame, docs: DataFrame, alpha: float = ALPHA, share: float = GENERALISE_SHARE) -> DataFrame:
    """entity, term, ratio (pmi / ic) of the terms that disclose an entity. found: from ``scanned``."""
    frequencies = saved(term_frequencies(docs), "frequencies")
    mentions = found.select(F.explode("mentions").alias("m")).groupBy("m.entity", "m.context").count()
    entities = saved(mentions.groupBy("entity").agg(F.sum("count").alias("df_entity"), F.count("*").alias("units")), "entities")
    total, tests = found.count(), frequencies.count() * entities.count()
    bits = math.log2(max(tests, 1) / alpha)
    able = entities.where(F.col("units") * F.log2(total / F.col("units")) >= bits)  # no term can be significant for the others
    terms = F.array_distinct(F.transform("words", lambda x: x.term))
    held = found.select(F.explode("mentions").alias("m"), terms.alias("terms")).select("m.entity", "m.context", "terms").join(able.select("entity"), "entity", "left_semi")
    pairs = held.select("entity", "context", F.explode("terms").alias("term")).groupBy("entity", "term", "context").count()
    pairs = pairs.groupBy("entity", "term").agg(F.sum("count").alias("both"), F.count("*").alias("units_both"))
    scored = pairs.join(able, "entity").join(frequencies, "term")
    pmi, ic = F.log2(total * F.col("both") / (F.col("df") * F.col("df_entity"))), F.log2(total / F.col("df_entity"))
    p = (F.col("df") - F.col("both") + F.col("units_both")) / (total - F.col("df_entity") + F.col("units"))
    q = F.col("units_both") / F.col("units")
    rest = F.when(q < 1, (1 - q) * F.log2((1 - q) / (1 - p))).otherwise(0.0)
    scored = scored.withColumns({"pmi": pmi, "ic": ic, "chance": F.when(q > p, F.col("units") * (q * F.log2(q / p) + rest)).otherwise(0.0)})
    return scored.where((F.col("ic") > 0) & (F.col("pmi") >= share * F.col("ic")) & (F.col("chance") >= bits)).select("entity", "term", (F.col("pmi") / F.col("ic")).alias("ratio"))


def found_spans(docs: DataFrame, remove_share: float = REMOVE_SHARE) -> DataFrame:
    """A row per row of docs: doc_id, text_key, counts, base_sha256, base, added (array of start, end, removed)."""
    found = saved(scanned(docs), "scanned")
    terms = saved(disclosing_terms(found, docs), "terms")
    held = found.select("doc_id", "text_key", "words", F.explode("mentions.entity").alias("entity")).join(terms.select("entity").distinct(), "entity", "left_semi")
    words = held.select("doc_id", "text_key", "entity", F.explode("words").alias("x")).select("doc_id", "text_key", "entity", "x.term", "x.start", "x.end")
    hits = words.join(terms, ["entity", "term"]).groupBy("doc_id", "text_key", "start", "end").agg(F.max(F.col("ratio") >= remove_share).alias("removed"))
    added = hits.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "removed"))).alias("added"))
    added = added.withColumnsRenamed({"doc_id": "added_id", "text_key": "added_key"})
    return found.drop("mentions", "words").join(added, [F.col("doc_id").eqNullSafe(F.col("added_id")), F.col("text_key") == F.col("added_key")], "left").drop("added_id", "added_key")


def spans_text() -> F.Column:
    """Base spans, then the added ones (removed: term, generalised: context), as kind:start:end."""
    extra = F.array_join(F.transform("added", lambda x: F.concat_ws(":", F.when(x.removed, "removed").otherwise("generalised"), x.start, x.end)), ",")
    return F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.size("added") > 0, extra))


def cut(text: str | None, spans: list[Span], added: list[dict] | None) -> str | None:
    """The text with base spans replaced by their kind, removed terms by nothing and generalised ones by their kind."""
    if not text or not (spans or added):
        return text
    marks = [(a, -b, f"[{k.upper()}]") for k, a, b in spans]
    marks += [(x["start"], -x["end"], "" if x["removed"] else "[NUMBER]" if text[x["start"] : x["end"]].isdigit() else "[TERM]") for x in added or []]
    out, end = [], 0
    for a, b, mark in sorted(marks):
        if a >= end:
            out += [text[end:a], mark]
            end = -b
        elif -b > end:  # an overlap goes with what it overlaps
            end = -b
    return "".join([*out, text[end:]])


def sanitised(docs: DataFrame) -> DataFrame:
    """docs with sanitised texts; n_chars, if there is such a column, follows the text. Columns as in docs.

    Base spans are found again where the text is, so only the few documents with added spans take part in a join."""
    own = {n: unused(docs, f"__{n}") for n in ("doc_id", "text_key", "added", "key")}
    marks = found_spans(docs).where(F.col("added").isNotNull()).select("doc_id", "text_key", "added").dropDuplicates(["doc_id", "text_key"])
    marks = saved(marks.withColumnsRenamed(own), "marks")
    keyed = docs.withColumn(own["key"], text_key(F.col("text")))
    both = keyed.join(marks, [keyed.doc_id.eqNullSafe(marks[own["doc_id"]]), F.col(own["key"]) == F.col(own["text_key"])], "left")
    names, added = docs.columns, own["added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cut(t, base_spans(t or ""), x) for t, x in zip(batch.column("text").to_pylist(), batch.column(added).to_pylist(), strict=True)]
            yield pa.record_batch([pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names)

    out = both.select(*[F.col(f"`{n}`") for n in names], added).mapInArrow(run, docs.schema)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
