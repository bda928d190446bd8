"""Study-shaped views over the driver tables, written once for Spark and once for DuckDB.

Labelled documents play the gold rows, the rest the weak rows; scores, states and
source tables are hash-derived so that both engines see the same values.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.hashing import uniform60
from tallyfold.functions.predicates import STATES, gold_label, nonempty, state_label
from tallyfold.operators.folds import leakage_groups

TARGETS = ("quality", "toxic")
SEED = 2026
SLOTS = (("Sagittal", "fluid"), ("Coronal", "fluid"), ("Axial", "fluid"), ("Sagittal", "structural"), ("Coronal", "structural"))


def r9(c: Column | str, digits: int = 9) -> Column:
    return F.round(c, digits)


def h(*parts: Column | str | int) -> Column:
    return uniform60(*parts)


def sql_h(expr: str) -> str:
    return f"(('0x' || substr(sha256({expr}), 1, 15))::BIGINT)"


STRIP_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"


def sql_nonempty(c: str) -> str:
    return f"coalesce(trim({c}, {STRIP_SQL}) NOT IN ('', 'nan', 'NaN', 'None'), false)"


_STATE_LIST = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"

BASE = f"""
WITH train AS (
  SELECT 'd' || d.doc_id AS uid, d.doc_id, d.text AS report, d.n_chars, d.lang, d.source AS site,
    CASE WHEN l.quality IS NULL THEN NULL WHEN {sql_h("'gq:d' || d.doc_id")} % 17 = 0 THEN '-1'
         WHEN {sql_h("'gq:d' || d.doc_id")} % 17 = 1 THEN '' ELSE l.quality::VARCHAR END AS quality,
    CASE WHEN l.toxic IS NULL THEN NULL WHEN {sql_h("'gt:d' || d.doc_id")} % 17 = 0 THEN '-1'
         WHEN {sql_h("'gt:d' || d.doc_id")} % 17 = 1 THEN ' ' ELSE l.toxic::VARCHAR END AS toxic
  FROM documents d LEFT JOIN labels l USING (doc_id)),
tgt AS (SELECT unnest(['quality', 'toxic']) AS target),
gold_text AS (
  SELECT uid, 'quality' AS target, quality AS v FROM train WHERE {sql_nonempty('quality')} OR {sql_nonempty('toxic')}
  UNION ALL SELECT uid, 'toxic', toxic FROM train WHERE {sql_nonempty('quality')} OR {sql_nonempty('toxic')}),
gold AS (SELECT uid, target, CASE v WHEN '0' THEN 0.0::DOUBLE WHEN '1' THEN 1.0::DOUBLE END AS y FROM gold_text),
states AS (
  SELECT uid, target, CASE WHEN {sql_h("'miss:' || target || ':' || uid")} % 23 = 0 THEN NULL
    ELSE {_STATE_LIST}[({sql_h("'state:' || target || ':' || uid")} % 5) + 1] END AS state FROM train, tgt),
weak_cells AS (
  SELECT uid, target, CASE state WHEN 'criterion_positive' THEN 1.0::DOUBLE WHEN 'explicit_negative' THEN 0.0::DOUBLE
      WHEN 'borderline_negative_hint' THEN 0.0::DOUBLE END AS y,
    CASE WHEN state IN ('criterion_positive', 'explicit_negative', 'borderline_negative_hint') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS mask,
    CASE WHEN state IN ('criterion_positive', 'explicit_negative') THEN 0.25::DOUBLE
         WHEN state = 'borderline_negative_hint' THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM states),
cells AS (
  SELECT uid, 'gold' AS source, target, y, (y IS NOT NULL)::INT::DOUBLE AS mask, (y IS NOT NULL)::INT::DOUBLE AS weight FROM gold
  UNION ALL SELECT uid, 'weak', target, y, mask, weight FROM weak_cells WHERE uid NOT IN (SELECT uid FROM gold)),
keyed AS (SELECT uid, CASE WHEN trim(report, {STRIP_SQL}) <> '' THEN sha256(trim(report, {STRIP_SQL})) END AS k FROM train),
grouped AS (SELECT uid, CASE WHEN k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 THEN k ELSE uid END AS group_id FROM keyed),
folds AS (
  SELECT uid, ({sql_h("'fold:' || group_id")} % 5)::INT AS fold, {sql_nonempty('quality')} AND {sql_nonempty('toxic')} AS is_gold,
    CASE WHEN NOT ({sql_nonempty('quality')} AND {sql_nonempty('toxic')}) THEN 'weak'
         WHEN {sql_h("'ge:' || uid")} % 2 = 0 THEN 'eval' ELSE 'train_image_ok' END AS gold_split, group_id
  FROM grouped JOIN train USING (uid)),
trainable AS (SELECT * FROM folds WHERE group_id NOT IN (SELECT group_id FROM folds WHERE gold_split = 'eval')),
models AS (SELECT unnest(['m1', 'm2', 'm3', 'm4']) AS model),
preds AS (
  SELECT model, CASE WHEN is_gold THEN 'gold' ELSE 'weak' END AS split, uid, target,
    (({sql_h("model || ':' || target || ':' || uid")} % 61) + (n_chars % 41))::DOUBLE / 100.0::DOUBLE AS p
  FROM train JOIN folds USING (uid), models, tgt),
scored AS (SELECT p.*, c.y FROM preds p JOIN cells c USING (uid, target) WHERE c.mask > 0),
srcs AS (SELECT unnest([{{'source': 's1', 'keep': 9}}, {{'source': 's2', 'keep': 8}}, {{'source': 's3', 'keep': 7}}], recursive := true)),
sources AS (
  SELECT source, uid, target, CASE WHEN {sql_h("'nul:' || source || ':' || target || ':' || uid")} % 20 = 0 THEN NULL
    ELSE ({sql_h("source || ':' || target || ':' || uid")} % 101)::DOUBLE / 100.0::DOUBLE END AS p
  FROM train, srcs, tgt WHERE {sql_h("'has:' || source || ':' || uid")} % 10 < keep),
series AS (
  SELECT DISTINCT 's' || l_orderkey AS study, 'p' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS series,
    CASE l_returnflag WHEN 'A' THEN 'Axial' WHEN 'N' THEN 'Coronal' ELSE 'Sagittal' END AS plane,
    CASE l_linestatus WHEN 'F' THEN '1' ELSE '0' END AS fluid, CASE WHEN l_discount >= 0.05 THEN '1' ELSE '0' END AS fat,
    l_quantity::INT AS n FROM lineitem),
headers AS (
  SELECT 's' || l_orderkey AS study, 'o' || l_orderkey AS series,
    'f' || l_partkey || '-' || l_suppkey || '-' || l_linenumber || '-' || floor(l_extendedprice)::BIGINT AS path,
    {sql_h("'tilt:' || l_orderkey || ':' || l_partkey || ':' || l_linenumber")} % 40 AS tilt,
    {sql_h("'mode:' || l_orderkey")} % 6 AS om, l_linenumber AS instance,
    floor(l_extendedprice * 100)::BIGINT % 1000 AS z, 'u' || l_partkey || '-' || l_suppkey AS sop FROM lineitem)
"""


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def train(self) -> DataFrame:
        d = self.raw("documents").join(self.raw("labels"), "doc_id", "left")
        uid = F.concat(F.lit("d"), F.col("doc_id").cast("string"))

        def text(name: str, tag: str, blank: str) -> Column:
            k = h(tag, uid) % 17
            return F.when(F.col(name).isNull(), F.lit(None).cast("string")).when(k == 0, F.lit("-1")).when(
                k == 1, F.lit(blank)).otherwise(F.col(name).cast("string")).alias(name)

        return d.select(uid.alias("uid"), "doc_id", F.col("text").alias("report"), "n_chars", "lang",
                        F.col("source").alias("site"), text("quality", "gq", ""), text("toxic", "gt", " "))

    @cached_property
    def grid(self) -> DataFrame:
        return self.train.select("uid", "n_chars", F.explode(F.array(*[F.lit(t) for t in TARGETS])).alias("target"))

    @cached_property
    def gold(self) -> DataFrame:
        rows = self.train.where(nonempty(F.col("quality")) | nonempty(F.col("toxic"))).select("uid", *TARGETS)
        return rows.unpivot(["uid"], list(TARGETS), "target", "v").select("uid", "target", gold_label(F.col("v"))["y"].alias("y"))

    @cached_property
    def states(self) -> DataFrame:
        pick = F.get(F.array(*[F.lit(s) for s in STATES]), (h("state", F.col("target"), F.col("uid")) % 5).cast("int"))
        gone = h("miss", F.col("target"), F.col("uid")) % 23 == 0
        return self.grid.select("uid", "target", F.when(~gone, pick).alias("state"))

    @cached_property
    def cells(self) -> DataFrame:
        lab = state_label(F.col("state"))
        weak = self.states.join(self.gold.select("uid").distinct(), "uid", "left_anti").select(
            "uid", F.lit("weak").alias("source"), "target", lab["y"].alias("y"), lab["mask"].alias("mask"), lab["weight"].alias("weight"))
        seen = F.col("y").isNotNull().cast("double")
        gold = self.gold.select("uid", F.lit("gold").alias("source"), "target", "y", seen.alias("mask"), seen.alias("weight"))
        return gold.unionByName(weak)

    @cached_property
    def folds(self) -> DataFrame:
        gold = nonempty(F.col("quality")) & nonempty(F.col("toxic"))
        g = leakage_groups(self.train, "uid", "report").join(self.train.select("uid", gold.alias("is_gold")), "uid")
        split = F.when(~F.col("is_gold"), F.lit("weak")).when(h("ge", F.col("uid")) % 2 == 0, F.lit("eval")).otherwise(
            F.lit("train_image_ok"))
        return g.select("uid", (h("fold", F.col("group_id")) % 5).cast("int").alias("fold"), "is_gold", split.alias("gold_split"), "group_id")

    @cached_property
    def preds(self) -> DataFrame:
        gold = nonempty(F.col("quality")) & nonempty(F.col("toxic"))
        rows = self.train.select("uid", "n_chars", gold.alias("g"), F.explode(F.array(*[F.lit(t) for t in TARGETS])).alias("target"))
        rows = rows.withColumn("model", F.explode(F.array(*[F.lit(m) for m in ("m1", "m2", "m3", "m4")])))
        p = (h(F.col("model"), F.col("target"), F.col("uid")) % 61 + F.col("n_chars") % 41).cast("double") / 100.0
        return rows.select("model", F.when(F.col("g"), F.lit("gold")).otherwise(F.lit("weak")).alias("split"), "uid", "target", p.alias("p"))

    @cached_property
    def scored(self) -> DataFrame:
        return self.preds.join(self.cells.where("mask > 0").select("uid", "target", "y"), ["uid", "target"])

    @cached_property
    def sources(self) -> DataFrame:
        keep = F.explode(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(k).alias("keep")) for s, k in (("s1", 9), ("s2", 8), ("s3", 7))]))
        rows = self.train.select("uid", keep.alias("k")).select("uid", "k.source", "k.keep")
        rows = rows.where(h("has", F.col("source"), F.col("uid")) % 10 < F.col("keep"))
        rows = rows.withColumn("target", F.explode(F.array(*[F.lit(t) for t in TARGETS])))
        gone = h("nul", F.col("source"), F.col("target"), F.col("uid")) % 20 == 0
        p = (h(F.col("source"), F.col("target"), F.col("uid")) % 101).cast("double") / 100.0
        return rows.select("source", "uid", "target", F.when(~gone, p).alias("p"))

    @cached_property
    def series(self) -> DataFrame:
        li = self.raw("lineitem")
        sid = F.concat(F.lit("p"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_linenumber")]))
        return li.select(
            F.concat(F.lit("s"), F.col("l_orderkey").cast("string")).alias("study"), sid.alias("series"),
            F.when(F.col("l_returnflag") == "A", "Axial").when(F.col("l_returnflag") == "N", "Coronal").otherwise("Sagittal").alias("plane"),
            F.when(F.col("l_linestatus") == "F", "1").otherwise("0").alias("fluid"),
            F.when(F.col("l_discount") >= 0.05, "1").otherwise("0").alias("fat"), F.col("l_quantity").cast("int").alias("n")).distinct()

    @cached_property
    def headers(self) -> DataFrame:
        """Slices: one per line of an order. A sixth of the orders lacks orientations, some lack instance numbers too."""
        li = self.raw("lineitem")
        ok, pk, sk, ln = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
        tilt = h("tilt", ok, pk, ln) % 40
        om = h("mode", ok) % 6
        z = F.floor(F.col("l_extendedprice") * 100) % 1000
        flat = F.array(*[F.lit(float(x)) for x in (1, 0, 0, 0, 1, 0)])
        tilted = F.array(*[F.lit(float(x)) for x in (1, 0, 0, 0, 0.6, 0.8)])
        return li.select(
            F.concat(F.lit("s"), ok).alias("study"), F.concat(F.lit("o"), ok).alias("series"),
            F.concat(F.lit("f"), F.concat_ws("-", pk, sk, ln, F.floor("l_extendedprice").cast("string"))).alias("path"),
            F.when(om != 0, F.when(tilt == 0, tilted).otherwise(flat)).alias("iop"),
            F.array(F.lit(0.0), F.lit(0.0), z.cast("double")).alias("ipp"),
            F.when((om != 0) | (h("inst", ok) % 2 == 0), F.col("l_linenumber")).alias("instance"),
            F.concat(F.lit("u"), F.concat_ws("-", pk, sk)).alias("sop"))
