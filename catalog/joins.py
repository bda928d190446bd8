"""Joins between predictions, labels, folds and receipts."""

from pyspark.sql import functions as F

from catalog import query
from catalog.base import BASE, TARGETS, Tables, h, r9, sql_h
from catalog.scans import ENV_SQL, envelopes
from tallyfold.operators import auc, contracts, folds, labels, selection, softlabels
from tallyfold.plans import review


@query("c1_predictions_labels", BASE + "SELECT model, split, uid, target, p, y FROM scored")
def c1(spark, d):
    t = Tables(spark, d)
    return review.score_long(t.preds, t.cells).select("model", "split", "uid", "target", "p", "y")


@query("c1_unlabelled_predictions", BASE + f"""
SELECT count(*) AS n_predicted, count(*) FILTER ({sql_h("'lab:' || uid")} % 3 = 0) AS skipped FROM train""")
def c1_skipped(spark, d):
    t = Tables(spark, d)
    return review.unlabelled(t.preds, t.cells.where(h("lab", F.col("uid")) % 3 != 0))


@query("c2_gold_override", BASE + f", {ENV_SQL} " + """
, gt AS (SELECT uid, target, trim(v) AS v FROM gold_text)
SELECT e.uid, CASE WHEN EXISTS (SELECT 1 FROM gold_text g WHERE g.uid = e.uid) THEN 'gold' ELSE 'weak' END AS source, e.target,
  CASE WHEN g.v <> '' THEN CASE WHEN g.v IN ('0', '1') THEN g.v::DOUBLE END ELSE e.y END AS y,
  CASE WHEN g.v <> '' THEN (g.v IN ('0', '1'))::INT::DOUBLE ELSE e.mask END AS mask, CASE WHEN g.v <> '' THEN (g.v IN ('0', '1'))::INT::DOUBLE ELSE e.weight END AS weight
FROM envc e LEFT JOIN gt g ON g.uid = e.uid AND g.target = e.target""")
def c2(spark, d):
    t = Tables(spark, d)
    return labels.canonical_cells(labels.tag_envelopes(envelopes(t)), t.train, TARGETS)


@query("c3_without_gold", BASE + "SELECT source, uid, target, p FROM sources WHERE uid NOT IN (SELECT uid FROM folds WHERE is_gold)")
def c3(spark, d):
    t = Tables(spark, d)
    return softlabels.without_gold(t.sources, t.folds.where("is_gold")).select("source", "uid", "target", "p")


@query("c4_trainable", BASE + "SELECT uid, fold FROM trainable")
def c4(spark, d):
    return folds.trainable(Tables(spark, d).folds).select("uid", "fold")


@query("c5_training_pool", BASE + """
SELECT uid FROM trainable WHERE fold NOT IN (0, 3) AND uid IN (SELECT uid FROM cells WHERE source <> 'gold' AND mask > 0)""")
def c5(spark, d):
    t = Tables(spark, d)
    return folds.training_pool(t.folds, t.cells, "0", ["3"])


@query("c6_soft_training_pool", BASE + """
SELECT uid FROM trainable WHERE fold NOT IN (0, 3) AND uid IN (SELECT uid FROM sources WHERE source = 's3' AND p IS NOT NULL)""")
def c6(spark, d):
    t = Tables(spark, d)
    return folds.soft_training_pool(t.folds, t.sources.where("source = 's3'"), "0", ["3"])


@query("c7_outer_roles", BASE + """
SELECT uid, CASE WHEN fold = 1 THEN 'weak' ELSE 'train' END AS role FROM trainable UNION ALL SELECT uid, 'gold' FROM folds WHERE gold_split = 'eval'""")
def c7(spark, d):
    return folds.outer_roles(Tables(spark, d).folds, "1")


@query("c7_outer_none", BASE + """SELECT uid, 'train' AS role FROM trainable UNION ALL SELECT uid, 'gold' FROM folds WHERE gold_split = 'eval'""")
def c7_none(spark, d):
    return folds.outer_roles(Tables(spark, d).folds, "none")


def covered(t):
    """Model m2 lacks a seventh of the weak ids and one gold id in thirty."""
    k = h("cov", F.col("uid"))
    lost = (F.col("model") == "m2") & F.when(F.col("split") == "weak", k % 7 == 0).otherwise(k % 30 == 0)
    return t.preds.where(~lost)


COVERED = f"""cov AS (SELECT * FROM preds WHERE NOT (model = 'm2' AND CASE WHEN split = 'weak' THEN {sql_h("'cov:' || uid")} % 7 = 0 ELSE {sql_h("'cov:' || uid")} % 30 = 0 END))"""


@query("c8_incomplete_pairs", BASE + f", {COVERED} " + """
SELECT 'incomplete_pairs' AS "check", split, uid, target FROM cov WHERE model = 'm1' AND split = 'gold' AND uid NOT IN (SELECT uid FROM cov WHERE model = 'm2')""")
def c8(spark, d):
    p = covered(Tables(spark, d))
    return contracts.incomplete_pairs(p.where("model = 'm1'"), p.where("model = 'm2'"), ["split", "uid", "target"], ["gold"])


@query("c8_paired_auc_delta", BASE + f", {COVERED} " + """
, pr AS (SELECT c.*, y FROM cov c JOIN cells l USING (uid, target) WHERE l.mask > 0 AND c.uid IN (SELECT uid FROM cov WHERE model = 'm2') AND c.model IN ('m1', 'm2')),
k AS (SELECT DISTINCT split, target, model FROM pr),
a AS (SELECT k.*, (SELECT sum(CASE WHEN x.p > z.p THEN 1.0 WHEN x.p = z.p THEN 0.5 ELSE 0 END)::DOUBLE / count(*) FROM pr x, pr z WHERE x.split = k.split AND z.split = k.split
   AND x.model = k.model AND z.model = k.model AND x.target = k.target AND z.target = k.target AND x.y = 1 AND z.y = 0) AS auc FROM k)
SELECT split, target, round(max(auc) FILTER (model = 'm1'), 9) AS auc_new, round(max(auc) FILTER (model = 'm2'), 9) AS auc_old,
  round(max(auc) FILTER (model = 'm1') - max(auc) FILTER (model = 'm2'), 9) AS delta FROM a GROUP BY 1, 2""")
def c8_delta(spark, d):
    t = Tables(spark, d)
    p = covered(t).where("model IN ('m1', 'm2')")
    both = p.join(p.where("model = 'm2'").select("split", "uid").distinct(), ["split", "uid"], "left_semi")
    out = auc.auc_delta(review.score_long(both, t.cells), "m1", "m2", ["split", "target"])
    return out.select("split", "target", *[r9(c).alias(c) for c in ("auc_new", "auc_old", "delta")])


@query("c9_exact_alignment", BASE + f", {COVERED} " + """
SELECT 0::BIGINT AS left_duplicates, 0::BIGINT AS right_duplicates, count(*) FILTER (uid NOT IN (SELECT uid FROM cov WHERE model = 'm2')) AS left_only, 0::BIGINT AS right_only
FROM (SELECT DISTINCT split, uid, target FROM cov WHERE model = 'm1')""")
def c9(spark, d):
    p = covered(Tables(spark, d))
    return selection.exact_alignment(p.where("model = 'm1'"), p.where("model = 'm2'"), ["split", "uid", "target"])


@query("c10_pair_cost_by_case", BASE + """
SELECT a.model, a.target, count(*) AS n_pairs, sum(CASE WHEN a.p < b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END)::DOUBLE AS cost
FROM scored a JOIN scored b ON a.model = b.model AND a.target = b.target AND a.y = 1 AND b.y = 0 GROUP BY 1, 2""")
def c10(spark, d):
    """Total positive-negative misorder cost; the pair table itself is never built."""
    out = auc.pair_summary(Tables(spark, d).scored, ["model", "target"])
    return out.select("model", "target", "n_pairs", F.col("misordered").alias("cost"))


@query("c11_source_pairs", BASE + """
SELECT a.uid, a.target, a.source AS source_a, b.source AS source_b, a.p AS pa, b.p AS pb FROM sources a JOIN sources b ON a.uid = b.uid AND a.target = b.target AND a.source < b.source""")
def c11(spark, d):
    from tallyfold.operators.agreement import source_pairs
    return source_pairs(Tables(spark, d).sources)


@query("c12_available_combine", BASE + "SELECT uid, target, count(p) AS n, round(avg(p), 9) AS p FROM sources GROUP BY 1, 2")
def c12(spark, d):
    rows = Tables(spark, d).sources
    return rows.groupBy("uid", "target").agg(F.count("p").alias("n"), r9(F.avg("p")).alias("p"))


@query("c13_common_ids", BASE + "SELECT uid FROM (SELECT DISTINCT source, uid FROM sources) GROUP BY 1 HAVING count(*) = 3")
def c13(spark, d):
    return selection.common_ids(Tables(spark, d).sources)


@query("c14_teacher_base_mix", BASE + """
SELECT t.uid, t.target, round(CASE WHEN b.p IS NULL THEN t.p ELSE 0.3::DOUBLE * b.p + 0.7::DOUBLE * t.p END, 6) AS p FROM (SELECT * FROM preds WHERE model = 'm1') t
LEFT JOIN (SELECT * FROM sources WHERE source = 's2') b USING (uid, target)""")
def c14(spark, d):
    t = Tables(spark, d)
    return softlabels.teacher_base_mix(t.preds.where("model = 'm1'"), t.sources.where("source = 's2'"), 0.3)


CAND = f"""cand AS (SELECT 's' || l_orderkey AS uid, {sql_h("'ver:' || l_orderkey || ':' || l_partkey || ':' || l_linenumber")} % 4 = 0 AS ok, l_quantity::INT AS n FROM lineitem)"""


def candidates(t):
    """Manifest rows with a nested candidate list per slot."""
    li = t.raw("lineitem")
    ok, pk, ln = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_linenumber")]
    flat = li.select(F.concat(F.lit("s"), ok).alias("uid"), (F.col("l_linenumber") % 2).alias("slot"),
                     F.struct((h("ver", ok, pk, ln) % 4 == 0).alias("anatomical_order_verified"), F.col("l_quantity").cast("int").alias("n")).alias("c"))
    per = flat.groupBy("uid", "slot").agg(F.collect_list("c").alias("cs"))
    return per.groupBy("uid").agg(F.collect_list("cs").alias("candidates"))


@query("c15_verified_candidates", f"WITH {CAND} SELECT DISTINCT uid FROM cand WHERE ok AND n >= 30")
def c15(spark, d):
    t = Tables(spark, d)
    ids = t.raw("lineitem").select(F.concat(F.lit("s"), F.col("l_orderkey").cast("string")).alias("uid")).distinct()
    return selection.with_verified_candidate(candidates(t), ids, 30)


@query("c16_shared_groups", BASE + f"""
SELECT DISTINCT group_id FROM folds WHERE {sql_h("'left:' || uid")} % 2 = 0 AND group_id IN (SELECT group_id FROM folds WHERE {sql_h("'left:' || uid")} % 2 = 1)""")
def c16(spark, d):
    f = Tables(spark, d).folds
    side = h("left", F.col("uid")) % 2
    return selection.shared_groups(f.where(side == 0), f.where(side == 1), f)


RECEIPT = f"""rc AS (SELECT o_orderkey AS run, CASE WHEN {sql_h("'r:' || o_orderkey")} % 20 = 0 THEN NULL ELSE 'r' || o_orderkey END AS receipt FROM orders),
rm AS (SELECT 'r' || o_orderkey AS ref, ['SubmissionStatus.COMPLETE', 'SubmissionStatus.ERROR', 'pending'][{sql_h("'st:' || o_orderkey")} % 3 + 1] AS status,
   {sql_h("'sc:' || o_orderkey")} % 120 AS sc, {sql_h("'dup:' || o_orderkey")} % 15 AS dup FROM orders WHERE {sql_h("'in:' || o_orderkey")} % 10 > 0)"""


@query("c17_receipt_reconciliation", f"WITH {RECEIPT} " + """
SELECT run, receipt, CASE WHEN receipt IS NULL THEN 'BLOCKED' WHEN ref IS NULL OR dup = 0 THEN 'PENDING' WHEN status = 'SubmissionStatus.COMPLETE' AND sc <= 100 THEN 'SCORED'
  WHEN status = 'SubmissionStatus.ERROR' THEN 'ERROR' ELSE 'PENDING' END AS status,
  CASE WHEN receipt IS NULL THEN 'server_receipt_missing' WHEN ref IS NULL OR dup = 0 THEN 'receipt_not_in_history' END AS reason,
  CASE WHEN ref IS NOT NULL AND dup > 0 AND status = 'SubmissionStatus.COMPLETE' AND sc <= 100 THEN sc::DOUBLE / 100 END AS score
FROM rc LEFT JOIN rm ON receipt = ref""")
def c17(spark, d):
    o = Tables(spark, d).raw("orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("k"))
    receipts = o.select(F.col("o_orderkey").alias("run"), F.when(h("r", F.col("k")) % 20 != 0, F.concat(F.lit("r"), "k")).alias("receipt"))
    status = F.get(F.array(*[F.lit(s) for s in ("SubmissionStatus.COMPLETE", "SubmissionStatus.ERROR", "pending")]), (h("st", F.col("k")) % 3).cast("int"))
    sc = h("sc", F.col("k")) % 120
    remote = o.where(h("in", F.col("k")) % 10 > 0).select(
        F.concat(F.lit("r"), "k").alias("ref"), status.alias("status"), (sc.cast("double") / 100).cast("string").alias("score"),
        F.lit(None).cast("string").alias("error"), F.explode(F.sequence(F.lit(1), F.when(h("dup", F.col("k")) % 15 == 0, 2).otherwise(1))).alias("x")).drop("x")
    return contracts.receipt_status(receipts, remote)


@query("c18_pool_gain", BASE + """
, a AS (SELECT uid FROM trainable WHERE fold <> 0 AND uid IN (SELECT uid FROM cells WHERE source <> 'gold' AND mask > 0)),
b AS (SELECT uid FROM trainable WHERE fold <> 0 AND uid IN (SELECT uid FROM sources WHERE source = 's1' AND p IS NOT NULL))
SELECT (SELECT count(*) FROM a) AS n_base, (SELECT count(*) FROM b) AS n_wider, (SELECT count(*) FROM b WHERE uid NOT IN (SELECT uid FROM a)) AS n_added""")
def c18(spark, d):
    t = Tables(spark, d)
    return folds.pool_gain(folds.training_pool(t.folds, t.cells, "0"), folds.soft_training_pool(t.folds, t.sources.where("source = 's1'"), "0"))
