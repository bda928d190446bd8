"""Hard negatives against a plain version, and packed products against plain ones."""

import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tallyfold.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, anchor int, part int, block int"


def plain(rows, every=10, most=5, low=80):
    usable = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, lab, v in usable:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, m) for i, m, w in usable if i != a)
        for s, i, _ in [x for x in scored if x[2] == lab][:most]:
            hard = [(t, j) for t, j, m in scored if m != lab and low * -s <= 100 * -t <= 100 * -s][:most]
            out += [(a, i, k, j, -s, -t) for k, (t, j) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, every=10):
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in negatives.mined(df, F.col("vec_id") % every == 0).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    out = [(i, [rng.gauss(0.3, 0.5) for _ in range(8)], rng.randrange(3)) for i in range(400)]
    out += [(400 + i, out[10][1], i % 3) for i in range(60)]  # ties
    out += [(500, None, 1), (501, [0.1] * 7 + [float("nan")], 1), (502, [0.1] * 7 + [None], 1), (503, [float("inf")] * 8, 0), (504, [0.1] * 8, None), (None, [9.0] * 8, 1)]
    return out + [(510, [], 1), (511, [0.5, 0.5], 0), (520, [1.0, 0.0, 2.0], 1), (530, [-1.0] * 8, 2)]


def test_mined_equals_the_plain_version(spark, rows):
    found = mined(spark, rows)
    assert found == plain(rows) and len(found) > 500


def test_small_blocks_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "CANDIDATES", 37)
    monkeypatch.setattr(negatives, "ANCHORS", 9)
    assert mined(spark, rows) == plain(rows)


def test_blocks_are_never_gathered_in_the_driver(spark, monkeypatch):
    """Some 250 KB of anchors, each block once for each of 28 blocks of candidates: a broadcast would hold 7 MB. The limit leaves room for counts."""
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0.1, 0.5) for _ in range(256)], rng.randrange(3)) for i in range(1000)]
    want = mined(spark, rows, 2)
    limit = spark.conf.get("spark.sql.maxBroadcastTableSize")
    monkeypatch.setattr(negatives, "CANDIDATES", 37)
    monkeypatch.setattr(negatives, "ANCHORS", 90)
    spark.conf.set("spark.sql.maxBroadcastTableSize", str(2 << 20))
    try:
        assert mined(spark, rows, 2) == want and len(want) > 500
    finally:
        spark.conf.set("spark.sql.maxBroadcastTableSize", limit)


def test_readers_hold_a_few_blocks_at_once(spark):
    """Some 5 MB of blocks of one task, 400 KB each, lie in row groups of some 4 MB."""
    number = F.transform(F.sequence(F.lit(0), F.lit(2047)), lambda i: F.xxhash64("id", i) % 30_000)
    table = negatives.blocks(spark.range(1200).coalesce(1).select("id", F.lit(1).cast("long").alias("label"), number.alias("vector")), 100, "blocks")
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in table.inputFiles()]
    sizes = [m.row_group(i).total_byte_size for m in groups for i in range(m.num_row_groups)]
    assert len(sizes) > 1 and max(sizes) < 6 << 20 and sorted(r.block for r in table.select("block").collect()) == list(range(12))


def test_empty_and_unusable_tables(spark, rows):
    assert mined(spark, [(10, None, 1), (20, [1.0], None)]) == [] == mined(spark, [(1, [1.0], 1), (2, [1.0], 2)])
    df = spark.createDataFrame([], SCHEMA)
    assert negatives.mined(df, F.col("vec_id") % 10 == 0).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.mined(df, F.col("vec_id") % 10 == 0).count() == 0


def test_repeated_rows_are_candidates_of_their_own(spark):
    rows = [(10, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (1, [1.0, 1.0], 0), (2, [1.0, 0.9], 1), (2, [1.0, 0.9], 1)]
    assert mined(spark, rows) == sorted([(10, 1, k, 2, 131072, 124416) for k in (1, 2)] * 2) == plain(rows)


def test_packed_products_are_exact():
    rng = np.random.default_rng(1)
    for low, high, dims in ((-256, 257, 64), (0, 2, 3), (-5, -1, 4), (-(1 << 20), 1 << 20, 32), (7, 8, 1)):
        c, a = rng.integers(low, high, (50, dims)), rng.integers(low, high, (6, dims))
        packed = negatives.Packed(c, int(a.min()), int(a.max()))
        assert all((packed.scores(x) == c @ x).all() for x in a)
    c = np.array([[255, -256], [3, 4]])
    assert negatives.Packed(c, -256, 256).scores(np.array([2])).tolist() == [510, 6]  # a shorter anchor ends in zeros
    with pytest.raises(OverflowError):
        negatives.Packed(np.array([[1 << 40]]), 0, 1 << 40)
