"""Near-duplicates by exact Jaccard similarity of word shingles: MinHash bands find candidates, shingle sets verify them.

A text is the set of its shingles of ``SHINGLE_WORDS`` words (a shorter text is one shingle). Two texts are linked when their sets have
a Jaccard similarity of ``4 / 5`` or more, counted in integers. Candidates share one of ``BANDS`` keys of ``ROWS`` MinHashes; at 0.8 a
pair has none in common with a chance of (1 - 0.8 ** 6) ** 40 = 5e-6, and above it with less. No bound on 64 SimHash bits does this: at
0.8 about ten of them differ, and no positional byte need agree.

Texts of equal words are one content. Contents that share a bucket are compared in two passes. The first links most of them with few
comparisons: each content with the bucket's ``PIVOTS`` most central contents and its smallest one. A content is the more central the
more contents it shares buckets with; a text that many edited copies stem from has in every band the key of most of them. The second
pass takes all pairs of a bucket that no chain of links joins yet, whatever the bucket's size, so no two similar contents of a bucket
stay in different components. Such a pair goes to the shingle sets unless sizes or ``BITS`` bits of parity prove that it is not near: a
shingle that only one of two sets has changes one bit, so sets differ in at least as many shingles as their parities do in bits.

``near_copies`` takes the links of the fingerprint index (``simhash``) as well: contents whose SimHash fingerprints differ in at most two
bits are found by its byte positions whatever bucket they fall into, none is lost, and both kinds of link make one set of components.

Null texts are empty, and texts without words are linked. Repeated rows share a content. Null doc_ids are linked like others. An empty
table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import byte_texts, only, saved, scratch, text_key
from tallyfold.llm.simhash import components, fingerprint
from tallyfold.llm.simhash import links as fingerprint_links

SHINGLE_WORDS = 5
BANDS = 40
ROWS = 6
PIVOTS = 3
#: Bits of the parities, in words of 64.
BITS = 1024
#: Contents of a bucket that are held against each other, or against as many others, in one task.
PIECE = 1024
SEED = 42
#: Odd multipliers that order the shingle hashes in as many ways.
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 31, (2, BANDS * ROWS), dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def content_of(data: bytes) -> tuple[bytes, list[bytes]]:
    """The words joined by a blank, and the words."""
    words = data.lower().split()
    return b" ".join(words), words


def shingles(data: bytes) -> np.ndarray:
    """Sorted different hashes of the shingles; none for a text without words."""
    joined, words = content_of(data)
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE_WORDS:
        return np.array([digest(joined, SEED)], np.uint64)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    return np.unique(np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[SHINGLE_WORDS:], strict=False)), np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed 64-bit key for each band."""
    if not len(hashes):
        return []
    half = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    least = np.full(FACTORS.shape[1], np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(half), 256):
        mixed = half[None, i : i + 256] * FACTORS[0][:, None]
        mixed ^= mixed >> np.uint32(16)
        mixed *= FACTORS[1][:, None]
        least = np.minimum(least, mixed.min(axis=1))
    return [xxhash.xxh64_intdigest(least[ROWS * b : ROWS * (b + 1)].tobytes(), b) - (1 << 63) for b in range(BANDS)]


def parities(hashes: np.ndarray) -> np.ndarray:
    """BITS bits as longs: each tells whether an odd number of the hashes falls on it."""
    odd = np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def near(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether two sets, sorted, have a similarity of 4 / 5 or more."""
    if 5 * min(len(left), len(right)) < 4 * max(len(left), len(right)):
        return False
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return 5 * shared >= 4 * (len(left) + len(right) - shared)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, content (a long that names the words), fp (their fingerprint), keys; one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            content = [xxhash.xxh64_intdigest(content_of(t)[0], SEED) - (1 << 63) for t in texts]
            fps = pa.array(np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64))
            keys = pa.array([band_keys(shingles(t)) for t in texts], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_key"), pa.array(content, pa.int64()), fps, keys], ["doc_id", "text_key", "content", "fp", "keys"])

    source = only(docs, "doc_id", "text").withColumn("text_key", text_key(F.col("text")))
    return source.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_key long, content long, fp long, keys array<long>")


def shingle_sets(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """content, hashes (binary), bits (their parities) of the contents of rows: doc_id, text_key, content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in byte_texts(batch.column("text"))]
            hashes, bits = pa.array([x.tobytes() for x in sets], pa.binary()), pa.array([parities(x) for x in sets], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column("content"), hashes, bits], ["content", "hashes", "bits"])

    source, r = only(docs, "doc_id", "text").withColumn("text_key", text_key(F.col("text"))).alias("d"), rows.alias("r")
    own = [F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")), F.col("d.text_key") == F.col("r.text_key")]
    return source.join(r, own).select("r.content", "d.text").mapInArrow(run, "content long, hashes binary, bits array<long>").dropDuplicates(["content"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of contents that are near. Sets are read from a table; the set of a content goes with each of its pairs once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.frombuffer(x, np.uint64) for x in batch.column(n).to_pylist()] for n in ("left", "right")]
            keep = pa.array([near(x, y) for x, y in zip(*sides, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    size = F.octet_length("hashes")
    left, right = (sets.select(F.col("content").alias(n), *extra) for n, extra in (("a", [size.alias("n_a")]), ("b", [size.alias("n_b")])))
    # most pairs that are not near differ in size: sizes travel first
    sized = pairs.join(left, "a").join(right, "b").where(5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b")).select("a", "b")
    left, right = (sets.select(F.col("content").alias(n), F.col("hashes").alias(side)) for n, side in (("a", "left"), ("b", "right")))
    return sized.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def ordered_pairs(found: DataFrame, x: str, y: str) -> DataFrame:
    """Different pairs (a, b), a < b, of two columns."""
    return found.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def pivots(met: DataFrame) -> DataFrame:
    """key, pivot: of each bucket the most central contents, and the smallest. met: key, content, n (the bucket's contents)."""
    central = met.groupBy("content").agg(F.sum("n").alias("score"))
    order = Window.partitionBy("key").orderBy(F.col("score").desc(), "content")
    ranked = met.select("key", "content").join(central, "content").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIVOTS)
    smallest = met.groupBy("key").agg(F.min("content").alias("pivot"))
    return ranked.select("key", F.col("content").alias("pivot")).unionByName(smallest)


def apart(met: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) of contents that share a bucket, have different roots and may be near: all but those that sizes or parities rule out.
    A bucket is dealt into pieces; each two of them meet in a place of their own. met: key, content, n; roots: node, root."""
    named = met.join(roots.withColumnRenamed("node", "content"), "content", "left").withColumn("root", F.coalesce("root", "content")).repartition("key")
    mixed = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    rest = saved(named.join(mixed, "key"), "rest")
    facts = rest.join(sets.select("content", F.octet_length("hashes").alias("size"), "bits"), "content").withColumn("pieces", F.ceil(F.col("n") / PIECE)).withColumn("piece", F.pmod("content", "pieces"))
    kept = ["key", "content", "root", "size", "bits"]
    left = facts.select(*kept, F.col("piece").alias("i"), F.explode(F.sequence("piece", F.col("pieces") - 1)).alias("j")).alias("x")
    right = facts.select(*kept, F.explode(F.sequence(F.lit(0).cast("long"), "piece")).alias("i"), F.col("piece").alias("j")).alias("y")
    x, y = (lambda name, side=side: F.col(f"{side}.{name}") for side in "xy")
    place = [x(name) == y(name) for name in ("key", "i", "j")]
    differ = sum((F.bit_count(x("bits")[k].bitwiseXOR(y("bits")[k])) for k in range(BITS // 64)), F.lit(0))
    open_pair = (x("root") != y("root")) & ((x("i") < x("j")) | (x("content") < y("content")))
    # near: the sets differ in a ninth of both sizes at most; sizes are bytes, 8 for a shingle
    near_enough = (5 * F.least(x("size"), y("size")) >= 4 * F.greatest(x("size"), y("size"))) & (72 * differ <= x("size").cast("long") + y("size"))
    pairs = left.join(right.hint("merge"), [*place, open_pair & near_enough])  # estimates leave out the repeats: no broadcast
    return pairs.select(F.least(x("content"), y("content")).alias("a"), F.greatest(x("content"), y("content")).alias("b")).distinct()


def similar(docs: DataFrame, rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of contents that have the components of all pairs that share a bucket and have a similarity of 4 / 5 or more, and of
    the known pairs. rows: scanned(docs)."""
    one = rows.groupBy("content").agg(F.first("keys").alias("keys"))
    keyed = one.select("content", F.explode("keys").alias("key")).repartition("key")  # one shuffle for the counts and for the rows
    met = saved(keyed.join(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key"), "met")
    mates = rows.select("doc_id", "text_key", "content").join(met.select("content").distinct(), "content", "left_semi")
    first = mates.groupBy("content").agg(F.min(F.struct("text_key", "doc_id")).alias("k")).select("content", "k.text_key", "k.doc_id")
    sets = saved(shingle_sets(docs, first), "shingles")
    tried = saved(ordered_pairs(met.select("key", "content").join(pivots(met), "key"), "content", "pivot"), "tried")
    links = saved(verified(tried, sets), "links")
    roots = saved(components(links if known is None else known.unionByName(links)), "roots")
    found = verified(saved(apart(met, sets, roots), "apart"), sets)
    return saved(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found), "links", outer=True)


def same_prints(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of contents that link those whose fingerprints are linked: each with the smallest of its fingerprint, and the
    smallest of linked fingerprints with one another. rows: scanned(docs)."""
    prints = saved(rows.groupBy("content").agg(F.first("fp").alias("fp")), "prints")
    least = saved(prints.groupBy("fp").agg(F.min("content").alias("least")), "least")
    equal = ordered_pairs(prints.join(least, "fp"), "content", "least")
    a, b = (least.select(F.col("fp").alias(n), F.col("least").alias(f"least_{n}")) for n in ("a", "b"))
    close = fingerprint_links(least.select("fp")).join(a, "a").join(b, "b")
    return saved(equal.unionByName(ordered_pairs(close, "least_a", "least_b")), "links", outer=True)


def near_duplicates(docs: DataFrame, prints: bool = False) -> DataFrame:
    """doc_id, text_key, component (a long that names it): a row per row of docs. With ``prints`` linked fingerprints link as well."""
    spark, rows = docs.sparkSession, saved(scanned(docs), "shingled")
    with scratch(spark):
        links = None
        if prints:
            with scratch(spark):
                links = same_prints(rows)
        with scratch(spark):
            found = similar(docs, rows, links)
        roots = saved(components(found), "roots", outer=True)
    return rows.join(roots, rows.content == roots.node, "left").select("doc_id", "text_key", F.coalesce("root", "content").alias("component"))


def near_copies(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` by both kinds of link: close fingerprints, and a similarity of 4 / 5 or more."""
    return near_duplicates(docs, prints=True)
