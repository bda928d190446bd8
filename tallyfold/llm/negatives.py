"""Hard-negative mining with Kronecker-packed products.

Vectors are integers: a component x is floor(SCALE * x). A block of candidates is packed by component: the candidates' components,
biased to be non-negative, lie in separated fields of one wide integer. The score of an anchor with all candidates of a block is then
one multiplication per component, summed: fields are as wide as the largest possible sum, so nothing is carried over, and the exact
inner products are read from the fields once the biases are taken off.

An anchor's positives are the ``POSITIVES`` other rows of its label with the highest scores; the negatives of a positive are the
``NEGATIVES`` best rows of other labels whose score is from ``LOW_SHARE`` hundredths of the positive's score up to that score. Higher
scores come first, ties by the smaller id. Anchors are held against all rows, in blocks of both: every task gets one block of
candidates and one of anchors, and leaves a few rows per anchor. There is no cap on what is compared. Negatives are a second pass,
since a positive is only known when all blocks have been seen.

Rows with a null id, a null label, a null vector, or a null or non-finite component take no part. A shorter vector ends in zeros. A row
is never its own positive: rows with the anchor's id are left out. Repeated ids are rows of their own as candidates, and each of
equal anchor rows gives its results. Empty vectors score 0. An empty table gives an empty result. Scores beyond a long are an error.
Columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import saved

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW_SHARE = 80
#: Rows of a block of candidates, and of anchors.
CANDIDATES, ANCHORS = 4096, 2048
#: Rows that hold blocks are large, and readers hold a row group at once: it ends after some MB, and each row is weighed.
SMALL_GROUPS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1"}
#: Types of stored components, the narrowest that holds a block's is taken.
KINDS = ("<i2", "<i4", "<i8")

ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, coalesce(list_sum(list_transform(list_zip(a.v, b.v, true), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY rank <= 5
"""


def whole(vector: Column, scale: int = SCALE) -> Column:
    """The integer vector of an array of numbers; null if a component is null or not finite."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(False)), F.transform(as_double, lambda x: F.floor(x * scale)))


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """The rows (id, label, vector) packed as bytes, at most ``size`` to a block, saved; ``block`` is a running number.

    Blocks are cut inside the tasks that read the rows, so no key decides where a row goes. Only the counts of blocks per task meet and
    are broadcast, a row per task; the blocks stay where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, np.ndarray]] = []
        part, done = TaskContext.get().partitionId(), 0

        def block(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            width = max(len(v) for _, _, v in rows)
            parts = np.zeros((len(rows), width), "<i8")
            for i, (_, _, v) in enumerate(rows):
                parts[i, : len(v)] = v
            kind = next(k for k in KINDS if np.array_equal(parts.astype(k), parts))
            ids, labels = (np.array([r[k] for r in rows], "<i8").tobytes() for k in (0, 1))
            cell = [[part], [done], [ids], [labels], [width], [parts.astype(kind).tobytes()]]
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
            return pa.record_batch([pa.array(x, t) for x, t in zip(cell, kinds, strict=True)], ["part", "inside", "ids", "labels", "width", "parts"])

        for batch in batches:
            vectors = [x.values.to_numpy(zero_copy_only=False) for x in batch.column("vector")]
            held += zip(batch.column("id").to_pylist(), batch.column("label").to_pylist(), vectors, strict=True)
            while len(held) >= size:
                yield block(held[:size])
                held, done = held[size:], done + 1
        if held:
            yield block(held)

    found = saved(rows.mapInArrow(run, "part int, inside int, ids binary, labels binary, width int, parts binary"), name, options=SMALL_GROUPS)
    per_task = found.groupBy("part").agg(F.count("*").alias("n"))
    before = per_task.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return found.join(F.broadcast(before), "part").select((F.col("before") + F.col("inside")).cast("int").alias("block"), "ids", "labels", "width", "parts")


@dataclass
class Rows:
    """A block in memory."""

    ids: np.ndarray
    labels: np.ndarray
    parts: np.ndarray

    @classmethod
    def read(cls, ids: bytes, labels: bytes, width: int, parts: bytes) -> Rows:
        ids = np.frombuffer(ids, "<i8")
        return cls(ids, np.frombuffer(labels, "<i8"), np.frombuffer(parts, f"<i{len(parts) // max(1, len(ids) * width)}" if parts else "<i8").astype(np.int64).reshape(len(ids), width))


class Packed:
    """Candidates packed for products with anchors whose components are ``low`` to ``high``."""

    def __init__(self, candidates: np.ndarray, low: int, high: int):
        n, self.dims = candidates.shape
        self.bias, self.anchor_bias = -min(0, int(candidates.min(initial=0))), -min(0, low)
        most = self.dims * (max(0, int(candidates.max(initial=0))) + self.bias) * (max(0, high) + self.anchor_bias)
        if most >= 1 << 55:
            raise OverflowError("scores beyond a long")
        self.n, self.field = n, 32 if most < 1 << 32 else 64
        biased = candidates + self.bias
        self.wide = [int.from_bytes(np.ascontiguousarray(biased[:, d]).astype(f"<u{self.field // 8}").tobytes(), "little") for d in range(self.dims)]
        self.sums = biased.sum(axis=1)

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products of an anchor with every candidate."""
        biased = [int(a) + self.anchor_bias for a in anchor[: self.dims]] + [self.anchor_bias] * (self.dims - len(anchor))
        total = sum(a * wide for a, wide in zip(biased, self.wide, strict=True))
        fields = np.frombuffer(total.to_bytes(self.n * self.field // 8, "little"), f"<u{self.field // 8}").astype(np.int64)
        return fields - self.bias * sum(biased) - self.anchor_bias * self.sums + self.dims * self.bias * self.anchor_bias


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` by falling score, then by id."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, -most)[-most])
    return at[np.lexsort((ids[at], -scores[at]))][:most]


def grid(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """A row per block of candidates (c_*) and block of anchors (a_*), each pair in a place of its own. Both tables are saved, with a
    running number ``block``. Both sides are shuffled: Spark's size estimate leaves out that a block is repeated for each block of the
    other side, so it would gather all repeated blocks of a short table in the driver for a broadcast."""
    n, m = candidates.count(), anchors.count()
    left = candidates.select(*[F.col(c).alias(f"c_{c}") for c in candidates.columns]).withColumn("a_block", F.explode(F.sequence(F.lit(0), F.lit(m - 1))) if m else F.lit(None).cast("int"))
    right = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns]).withColumn("c_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n else F.lit(None).cast("int"))
    return left.join(right.hint("merge"), ["c_block", "a_block"])


def _pairs(batch: pa.RecordBatch) -> Iterator[tuple[dict, Rows, Rows, Packed]]:
    for k in range(batch.num_rows):
        row = batch.slice(k, 1).to_pylist()[0]
        c, a = (Rows.read(*[row[f"{side}_{x}"] for x in ("ids", "labels", "width", "parts")]) for side in "ca")
        yield row, c, a, Packed(c.parts, int(a.parts.min(initial=0)), int(a.parts.max(initial=0)))


def positives(candidates: DataFrame, anchors: DataFrame, most: int = POSITIVES) -> DataFrame:
    """a_block, place (of the anchor in its block), id, score, rank: the best other rows of each anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, c, a, packed in _pairs(batch):
                place, ids, scores = [], [], []
                for i, (anchor, label) in enumerate(zip(a.ids, a.labels, strict=True)):
                    own = np.flatnonzero((c.labels == label) & (c.ids != anchor))
                    if len(own):
                        score = packed.scores(a.parts[i])[own]
                        at = best(score, c.ids[own], most)
                        place.append(np.full(len(at), i, np.int32))
                        ids.append(c.ids[own[at]])
                        scores.append(score[at])
                if place:
                    place = np.concatenate(place)
                    yield pa.record_batch([pa.array(np.full(len(place), row["a_block"], np.int32)), pa.array(place), pa.array(np.concatenate(ids)), pa.array(np.concatenate(scores))], ["a_block", "place", "id", "score"])

    found = grid(candidates, anchors).mapInArrow(run, "a_block int, place int, id long, score long")
    order = Window.partitionBy("a_block", "place").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def negatives(candidates: DataFrame, anchors: DataFrame, found: DataFrame, most: int = NEGATIVES, low_share: int = LOW_SHARE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for each positive of ``found``."""
    wanted = found.groupBy("a_block").agg(F.collect_list(F.struct("place", "rank", "id", "score")).alias("a_positives"))  # of one block: bounded
    with_positives = anchors.join(wanted.withColumnRenamed("a_block", "block"), "block").withColumnRenamed("a_positives", "positives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a_block", "place", "positive_rank", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        for batch in batches:
            for row, c, a, packed in _pairs(batch):
                out, last, scores, own = [], None, None, None
                for p in sorted(row["a_positives"], key=lambda p: (p["place"], p["rank"])):
                    i, score = p["place"], p["score"]
                    if score < 0:
                        continue
                    if i != last:
                        last, scores = i, packed.scores(a.parts[i])
                        own = np.flatnonzero((c.labels != a.labels[i]) & (scores >= 0))
                    s = scores[own]
                    at = own[(100 * s >= low_share * score) & (s <= score)]
                    at = at[best(scores[at], c.ids[at], most)]
                    out += [(row["a_block"], i, p["rank"], int(a.ids[i]), p["id"], score, int(x), int(y)) for x, y in zip(c.ids[at], scores[at], strict=True)]
                if out:
                    kinds = [pa.int32()] * 3 + [pa.int64()] * 5
                    yield pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    pairs = grid(candidates, with_positives).mapInArrow(run, "a_block int, place int, positive_rank int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("a_block", "place", "positive_rank").orderBy(F.col("negative_score").desc(), "negative_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(rows: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE,
          n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, low_share: int = LOW_SHARE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. is_anchor: a condition on the table's columns."""
    usable = rows.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), whole(F.col(f"`{vector}`"), scale).alias("vector"), is_anchor.alias("anchor")).dropna(subset=["id", "label", "vector"])
    candidates = blocks(usable.drop("anchor"), CANDIDATES, "candidates")
    chosen = saved(usable.where("anchor").drop("anchor"), "anchors")
    anchors = blocks(chosen.repartition(-(-chosen.count() // ANCHORS) or 1), ANCHORS, "anchors")
    found = saved(positives(candidates, anchors, n_positives), "positives")
    return negatives(candidates, anchors, found, n_negatives, low_share)
