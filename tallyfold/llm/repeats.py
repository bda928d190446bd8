"""Removal of long repeated byte strings: distributed prefix doubling over sparse positions.

A byte goes when a string of ``length`` bytes that covers it also starts anywhere else. Prefix doubling gives equal strings equal
ranks, at lengths that double until positions are unique or the threshold is reached. Two things keep it small:

* Ranks up to ``gram`` bytes need no sort: they are pairs of ranks hashed in the task, 1, 2, 4, ... bytes long.
* Every string of ``length`` bytes is represented by one anchor, its gram of the lowest rank (the leftmost of equals). Equal strings
  have the same anchor at the same offset, so only about 2 / (length - gram) of all positions are ranked across the corpus.

Round one sorts (rank of the gram, position) pairs; unique positions drop out. Each pair also has the rank of the whole stretch that
the anchor's strings cover: where that occurs twice, all its strings are repeated. Round two ranks the strings of ``length`` bytes
one by one, for anchors whose gram occurs elsewhere in a different stretch, with one witness of each repeated stretch. Stretches of
one gram meet in one task while they are at most ``GROUP``; strings of more frequent grams are dealt out by their own rank.

Ranks are 64-bit hashes of the bytes, so equal strings have equal ranks and different ones differ but for a chance of n * n / 2**65.

Null texts are empty. Texts shorter than ``length`` keep all. Matches never cross documents. Copies, repeated rows and repeated or
null doc_ids count as other places. An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyfold.llm.common import byte_texts, only, saved, text_key

LENGTH = 200
GRAM = 64
#: Stretches of one gram that may meet in one task: at some 140 strings each, their ranks take at most 25 MB there.
GROUP = 20_000
#: Bytes that are ranked at once; positions in them need ``PLACE`` bits.
CHUNK, PLACE = 900_000, np.uint64(20)
MIX = np.uint64(0x9E3779B97F4A7C15)
BYTE_RANKS = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_ranks(data: np.ndarray, gram: int) -> np.ndarray:
    """The rank of the ``gram`` (a power of two) bytes from each position on, by doubling."""
    h, width = BYTE_RANKS[data], 1
    while width < gram:
        left = h[:-width]
        h = (left ^ (left >> np.uint64(29))) * MIX + h[width:]
        width *= 2
    return h ^ (h >> np.uint64(32))


def anchors(data: bytes, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """For texts at ``starts`` of data: text number, gram rank, first string, number of strings and the anchor's offset from the first
    string, for each run of strings with one anchor."""
    none = np.zeros(0, np.int64)
    n = len(data) - length + 1
    if n <= 0:
        return none, none.astype(np.uint64), none, none, none
    h = gram_ranks(np.frombuffer(data, np.uint8), gram)
    low = (h >> PLACE << PLACE) | np.arange(len(h), dtype=np.uint64)
    grams, width = length - gram + 1, 1
    while 2 * width <= grams:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < grams:
        low = np.minimum(low[: n], low[grams - width : grams - width + n])
    place = (low[:n] & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)
    inside = np.zeros(n + 1, np.int64)
    long = sizes >= length
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, starts[long] + sizes[long] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(at):
        return none, none.astype(np.uint64), none, none, none
    own = place[at]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)])
    first, count = at[new], np.diff(np.r_[new, len(at)])
    text = np.searchsorted(starts, first, side="right") - 1
    return text, h[own[new]], first, count, own[new] - first


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in chunks: the bytes, numbers of the texts, where they start in the bytes, their sizes there, and where that is in the
    text. Texts longer than a chunk come in overlapping parts, so that each string is in one of them."""
    run: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) > CHUNK:
            for a in range(0, len(text) - length + 1, CHUNK - length + 1):
                part = text[a : a + CHUNK]
                yield part, np.array([i]), np.array([0]), np.array([len(part)]), np.array([a])
        elif len(text) >= length:
            if size + len(text) > CHUNK:
                yield _joined(texts, run)
                run, size = [], 0
            run.append(i)
            size += len(text)
    if run:
        yield _joined(texts, run)


def _joined(texts: list[bytes], run: list[int]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(texts[i]) for i in run], np.int64)
    return b"".join([texts[i] for i in run]), np.array(run), np.cumsum(sizes) - sizes, sizes, np.zeros(len(run), np.int64)


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def first_ranks(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """gram, stretch (ranks), text_key, first, n (strings), lead (offset of the anchor; -1: known to be repeated), times."""
    rank = xxhash.xxh3_64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = byte_texts(batch.column("text")), batch.column("text_key").to_numpy()
            for data, numbers, starts, sizes, offsets in pieces(texts, length):
                text, grams, first, n, lead = anchors(data, starts, sizes, length, gram)
                stretch = np.fromiter((rank(data[a:b], seed) for a, b, seed in zip(first.tolist(), (first + n + length - 1).tolist(), lead.tolist(), strict=True)), np.uint64, len(first))
                key, first = keys[numbers[text]], first - starts[text] + offsets[text]
                # a stretch that repeats here is repeated for sure: one row speaks for it to the others
                both = np.stack([grams, stretch], axis=1)
                _, at, inverse, times = np.unique(both, axis=0, return_index=True, return_inverse=True, return_counts=True) if _repeats(stretch) else (None, np.arange(len(first)), None, np.ones(len(first), np.int64))
                columns = [signed(grams[at]), signed(stretch[at]), pa.array(key[at]), pa.array(first[at]), pa.array(n[at]), pa.array(lead[at]), pa.array(np.minimum(times, 2))]
                yield pa.record_batch(columns, NAMES)
                if inverse is not None:
                    again = np.flatnonzero(times[inverse.ravel()] > 1)
                    again = again[np.lexsort((first[again], text[again]))]
                    k, a, b = text[again], first[again], first[again] + n[again]
                    new = np.r_[True, (k[1:] != k[:-1]) | (a[1:] > b[:-1])]
                    begin = np.flatnonzero(new)
                    stop = b[np.r_[begin[1:] - 1, len(b) - 1]]
                    ones = np.ones(len(begin), np.int64)
                    yield pa.record_batch([pa.array(key[again][begin]), pa.array(key[again][begin]), pa.array(key[again][begin]), pa.array(a[begin]), pa.array(stop - a[begin]), pa.array(-ones), pa.array(ones)], NAMES)

    source = only(docs, "text").where(F.octet_length("text") >= length).withColumn("text_key", text_key(F.col("text")))
    return source.mapInArrow(run, ", ".join(f"{n} long" for n in NAMES))


NAMES = ["gram", "stretch", "text_key", "first", "n", "lead", "times"]


def _repeats(values: np.ndarray) -> bool:
    order = np.sort(values)
    return bool((order[1:] == order[:-1]).any())


def repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """text_key, first, n: runs of n strings, each of which also starts somewhere else."""
    by_gram, by_stretch = W.partitionBy("gram"), W.partitionBy("gram", "stretch")
    ranked = first_ranks(docs, length, gram).repartition("gram").withColumn("same", F.sum("times").over(by_stretch)).withColumn(
        "number", F.row_number().over(by_stretch.orderBy("text_key", "first"))).withColumn("least", F.min("same").over(by_gram)).withColumn("all", F.sum("times").over(by_gram))
    left = saved(ranked.where("lead < 0 or all > 1").select(
        "gram", "text_key", "first", "n", F.expr("lead < 0 or same > 1").alias("known"), F.expr("lead >= 0 and least = 1 and number = 1 and all > same").alias("compare"),
        (F.col("all") > group).alias("large")), "ranked")
    known = left.where("known").select("text_key", "first", "n").distinct()
    found = left.where("compare").groupBy("text_key").agg(F.collect_list(F.struct("gram", "first", "n", "known", "large")).alias("anchors"))  # of one text
    texts = only(docs, "text").where(F.octet_length("text") >= length).withColumn("text_key", text_key(F.col("text")))
    stretches = saved(_stretches(texts.join(found, "text_key").select("text_key", "text", "anchors"), length), "stretches")
    return known.unionByName(_within_groups(stretches.where("not large"), length)).unionByName(_across(stretches.where("large"), length))


def _stretches(texts: DataFrame, length: int) -> DataFrame:
    """gram, text_key, first, known, large, bytes (of the whole stretch) for the anchors of each text."""
    names = ["gram", "text_key", "first", "known", "large", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for key, text, found in zip(batch.column("text_key").to_pylist(), byte_texts(batch.column("text")), batch.column("anchors"), strict=True):
                if key == last:  # a copy of the text before
                    continue
                last = key
                gram, first, n, known, large = (found.values.field(i) for i in range(5))
                parts = [text[a : a + k + length - 1] for a, k in zip(first.to_pylist(), n.to_pylist(), strict=True)]
                yield pa.record_batch([gram, pa.array([key] * len(parts), pa.int64()), first, known, large, pa.array(parts, pa.binary())], names)

    return texts.mapInArrow(run, "gram long, text_key long, first long, known boolean, large boolean, bytes binary")


def string_ranks(stretch: bytes, length: int) -> np.ndarray:
    rank = xxhash.xxh3_64_intdigest
    return np.fromiter((rank(stretch[a : a + length]) for a in range(len(stretch) - length + 1)), np.uint64)


def _within_groups(stretches: DataFrame, length: int) -> DataFrame:
    """Round two for grams of at most GROUP stretches: they meet in one task, sorted by gram."""

    def repeated(rows: list[tuple[int, int, bool, bytes]]) -> Iterator[tuple[int, int, int]]:
        ranks = [string_ranks(b, length) for _, _, _, b in rows]
        _, inverse, counts = np.unique(np.concatenate(ranks), return_inverse=True, return_counts=True)
        twice, end = counts[inverse] > 1, 0
        for (key, first, known, _), r in zip(rows, ranks, strict=True):
            own, end = twice[end : end + len(r)], end + len(r)
            if not known and own.any():
                edge = np.flatnonzero(np.diff(np.r_[0, own.astype(np.int8), 0]))
                yield from ((key, first + a, b - a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, rows = None, []

        def table(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], ["text_key", "first", "n"])

        for batch in batches:
            out = []
            for g, *row in zip(*[batch.column(c).to_pylist() for c in ("gram", "text_key", "first", "known", "bytes")], strict=True):
                if g != gram:
                    if len(rows) > 1:
                        out += repeated(rows)
                    gram, rows = g, []
                rows.append(tuple(row))
            yield table(out)
        if len(rows) > 1:
            yield table(list(repeated(rows)))

    return stretches.drop("large").repartition("gram").sortWithinPartitions("gram").mapInArrow(run, "text_key long, first long, n long")


def _across(stretches: DataFrame, length: int) -> DataFrame:
    """Round two for grams of more stretches: a row per string, dealt by its rank, so that no group meets in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranks = [string_ranks(b, length) for b in batch.column("bytes").to_pylist()]
            sizes = np.array([len(r) for r in ranks], np.int64)
            if len(sizes):
                at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                gram, key, first, known = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), sizes) for c in ("gram", "text_key", "first", "known"))
                yield pa.record_batch([pa.array(gram), signed(np.concatenate(ranks)), pa.array(key), pa.array(first + at), pa.array(known)], ["gram", "rank", "text_key", "first", "known"])

    strings = stretches.mapInArrow(run, "gram long, rank long, text_key long, first long, known boolean")
    twice = strings.groupBy("gram", "rank").agg(F.count("*").alias("times")).where("times > 1")
    return strings.where("not known").join(twice, ["gram", "rank"]).select("text_key", "first", F.lit(1).cast("long").alias("n"))


def kept_parts(text: bytes, first: list[int], n: list[int], length: int) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs of them, and what is left."""
    removed, spans, out, end = 0, 0, [], 0
    start = -1
    for a, k in sorted(zip(first, n, strict=True)):
        b = a + k - 1 + length
        if start < 0 or a > end:
            out.append(text[end if start >= 0 else 0 : a])
            removed, spans, start, end = removed + b - a, spans + 1, a, b
        elif b > end:
            removed, end = removed + b - end, b
    out.append(text[end:] if start >= 0 else text)
    return removed, spans, b"".join(out)


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, with_text: bool = False, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, on request, kept (the remaining bytes); a row per row of docs."""
    runs = repeated_strings(docs, length, gram, group).groupBy("text_key").agg(F.collect_list("first").alias("first"), F.collect_list("n").alias("n"))  # of one text
    runs = runs.withColumnRenamed("text_key", "run_key")
    source = only(docs, "doc_id", "text").withColumn("text_key", text_key(F.col("text")))
    both = source.join(runs, source.text_key == runs.run_key, "left").select("doc_id", "text", "first", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, first, n in zip(byte_texts(batch.column("text")), batch.column("first").to_pylist(), batch.column("n").to_pylist(), strict=True):
                removed, spans, kept = kept_parts(text, first or [], n or [], length)
                rows.append((len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            arrays = [*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string()), pa.array(columns[4], pa.binary())]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.record_batch([batch.column("doc_id"), *arrays[: 4 + with_text]], ["doc_id", *names[: 4 + with_text]])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return both.mapInArrow(run, schema)
