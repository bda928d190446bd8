"""Contracts and promotion rules over deliberately damaged tables."""

from pyspark.sql import functions as F

from catalog import query
from catalog.aggregates import auc_sql
from catalog.base import BASE, TARGETS, Tables, h, r9, sql_h
from tallyfold.operators import auc, contracts, labels, manifest, softlabels
from tallyfold.operators.reshape import to_wide
from tallyfold.scale import ordinal_rank

TRAIN_IDS = f"tr AS (SELECT uid FROM folds WHERE {sql_h(chr(39) + 'tr:' + chr(39) + ' || uid')} % 3 = 0)"


def _train_ids(t):
    return t.folds.where(h("tr", F.col("uid")) % 3 == 0).select("uid")


MOVED = f"""mv AS (SELECT uid, CASE WHEN {sql_h("'mv:' || uid")} % 20 = 0 THEN (fold + 1) % 5 ELSE fold END AS fold, group_id FROM folds UNION ALL
  SELECT uid, (fold + 2) % 5, group_id FROM folds WHERE {sql_h("'tw:' || uid")} % 50 = 0)"""


@query("k1_group_integrity", BASE + f", {MOVED} " + """
SELECT 'study_in_multiple_folds' AS "check", uid AS key FROM mv GROUP BY uid HAVING count(DISTINCT fold) > 1 UNION ALL SELECT 'group_split_across_folds', group_id FROM mv GROUP BY group_id HAVING count(DISTINCT fold) > 1""")
def k1(spark, d):
    f = Tables(spark, d).folds
    moved = f.withColumn("fold", F.when(h("mv", F.col("uid")) % 20 == 0, (F.col("fold") + 1) % 5).otherwise(F.col("fold")))
    twice = f.where(h("tw", F.col("uid")) % 50 == 0).withColumn("fold", (F.col("fold") + 2) % 5)
    return contracts.group_integrity(moved.unionByName(twice))


@query("k2_eval_in_training", BASE + f", {TRAIN_IDS} " + """SELECT 'gold_eval_in_training' AS "check", uid AS key FROM tr WHERE uid IN (SELECT uid FROM folds WHERE gold_split = 'eval')""")
def k2(spark, d):
    t = Tables(spark, d)
    return contracts.eval_in_training(_train_ids(t), t.folds)


@query("k3_outside_trainable", BASE + f", {TRAIN_IDS} " + """SELECT 'outside_trainable' AS "check", uid AS key FROM tr WHERE uid NOT IN (SELECT uid FROM trainable)""")
def k3(spark, d):
    t = Tables(spark, d)
    return contracts.outside_trainable(_train_ids(t), t.folds)


ROLES = f"""ro AS (SELECT uid, group_id, ['train', 'weak', 'gold'][{sql_h("'role:' || uid")} % 3 + 1] AS role FROM folds UNION ALL SELECT uid, group_id, 'gold' FROM folds WHERE {sql_h("'tw:' || uid")} % 50 = 0)"""


@query("k4_split_overlap", BASE + f", {ROLES} " + """
SELECT 'split_overlap' AS "check", uid AS key FROM ro GROUP BY uid HAVING count(DISTINCT role) > 1 UNION ALL SELECT 'group_crosses_splits', group_id FROM ro GROUP BY group_id HAVING count(DISTINCT role) > 1""")
def k4(spark, d):
    f = Tables(spark, d).folds
    role = F.get(F.array(F.lit("train"), F.lit("weak"), F.lit("gold")), (h("role", F.col("uid")) % 3).cast("int"))
    roles = f.select("uid", role.alias("role")).unionByName(f.where(h("tw", F.col("uid")) % 50 == 0).select("uid", F.lit("gold").alias("role")))
    return contracts.split_overlap(roles, f)


BADP = f"""w AS (SELECT uid, split, max(p) FILTER (target = 'quality') AS quality, max(p) FILTER (target = 'toxic') AS toxic FROM preds WHERE model = 'm1' GROUP BY 1, 2),
bp AS (SELECT uid, CASE WHEN k = 0 THEN 'train' ELSE split END AS split, CASE k WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN 1.01::DOUBLE WHEN 3 THEN NULL ELSE quality END AS quality, toxic FROM (SELECT *, {sql_h("'bp:' || uid")} % 40 AS k FROM w)
  UNION ALL SELECT uid, split, quality, toxic FROM w WHERE {sql_h("'bp:' || uid")} % 40 = 4 UNION ALL SELECT uid, CASE split WHEN 'gold' THEN 'weak' ELSE 'gold' END, quality, toxic FROM w WHERE {sql_h("'bp:' || uid")} % 40 = 5)"""


@query("k5_prediction_violations", BASE + f", {BADP} " + """
SELECT 'duplicate_prediction_uid' AS "check", uid AS key FROM bp GROUP BY split, uid HAVING count(*) > 1 UNION ALL SELECT 'prediction_split_overlap', uid FROM bp GROUP BY uid HAVING count(DISTINCT split) > 1
UNION ALL SELECT 'invalid_prediction_split', uid FROM bp WHERE split NOT IN ('gold', 'weak') UNION ALL SELECT 'invalid_prediction_probability', uid FROM bp WHERE NOT coalesce(quality BETWEEN 0 AND 1 AND NOT isnan(quality), false)""")
def k5(spark, d):
    w = to_wide(Tables(spark, d).preds.where("model = 'm1'"), ["uid", "split"], TARGETS)
    k = h("bp", F.col("uid")) % 40
    q = F.when(k == 1, F.lit(float("nan"))).when(k == 2, F.lit(1.01)).when(k == 3, F.lit(None).cast("double")).otherwise(F.col("quality"))
    bad = w.withColumn("split", F.when(k == 0, F.lit("train")).otherwise(F.col("split"))).withColumn("quality", q)
    flip = F.when(F.col("split") == "gold", F.lit("weak")).otherwise(F.lit("gold"))
    return contracts.prediction_violations(bad.unionByName(w.where(k == 4)).unionByName(w.where(k == 5).withColumn("split", flip)), TARGETS)


@query("k6_prediction_coverage", BASE + f"""
, pp AS (SELECT uid, CASE WHEN gold_split = 'eval' THEN 'gold' ELSE 'weak' END AS split FROM folds WHERE {sql_h("'pc:' || uid")} % 15 > 0 AND (gold_split = 'eval' OR fold = 2 OR {sql_h("'pc:' || uid")} % 15 = 1))
SELECT 'gold_not_predicted' AS "check", uid AS key FROM folds WHERE gold_split = 'eval' AND uid NOT IN (SELECT uid FROM pp)
UNION ALL SELECT 'weak_outside_outer_fold', uid FROM pp WHERE split = 'weak' AND uid NOT IN (SELECT uid FROM folds WHERE fold = 2 AND gold_split <> 'eval')
UNION ALL SELECT 'weak_not_predicted', uid FROM folds WHERE fold = 2 AND gold_split <> 'eval' AND uid NOT IN (SELECT uid FROM pp WHERE split = 'weak')""")
def k6(spark, d):
    f = Tables(spark, d).folds
    k = h("pc", F.col("uid")) % 15
    ev = F.col("gold_split") == "eval"
    preds = f.where((k > 0) & (ev | (F.col("fold") == 2) | (k == 1))).select("uid", F.when(ev, "gold").otherwise("weak").alias("split"))
    return contracts.prediction_coverage(preds, f, "2")


SUB = f"""rq AS (SELECT uid, row_number() OVER (ORDER BY uid) - 1 AS row_ix FROM train),
sb AS (SELECT r.row_ix, CASE WHEN k = 0 THEN 'other' || r.uid WHEN k = 1 THEN (SELECT uid FROM rq q WHERE q.row_ix = r.row_ix + 1) ELSE r.uid END AS uid,
  CASE k WHEN 2 THEN 'abc' WHEN 3 THEN '1.5' WHEN 4 THEN 'NaN' ELSE '0.25' END AS quality, '0.5' AS toxic FROM (SELECT *, {sql_h("'sub:' || uid")} % 50 AS k FROM rq) r)"""


@query("k7_submission_violations", BASE + f", {SUB} " + """
, hv AS (SELECT uid, count(*) AS a FROM sb WHERE uid IS NOT NULL GROUP BY 1)
SELECT 'nonfloat' AS "check", uid || ':quality' AS key FROM sb WHERE quality = 'abc' UNION ALL SELECT 'not_prob', coalesce(uid || ':', '') || 'quality' FROM sb WHERE quality IN ('1.5', 'NaN')
UNION ALL SELECT 'uid_set_mismatch', coalesce(hv.uid, rq.uid) FROM hv FULL JOIN rq ON hv.uid = rq.uid WHERE a IS DISTINCT FROM CASE WHEN rq.uid IS NULL THEN NULL ELSE 1 END
UNION ALL SELECT 'uid_order_differs', coalesce(s.uid, r.uid) FROM sb s JOIN rq r USING (row_ix) WHERE s.uid IS DISTINCT FROM r.uid""")
def k7(spark, d):
    t = Tables(spark, d)
    req = ordinal_rank(t.train.select("uid"), [], [F.col("uid")], "row_ix").withColumn("row_ix", F.col("row_ix") - 1)
    k = h("sub", F.col("uid")) % 50
    nxt = req.select((F.col("row_ix") - 1).alias("row_ix"), F.col("uid").alias("nxt"))
    q = F.when(k == 2, "abc").when(k == 3, "1.5").when(k == 4, "NaN").otherwise("0.25")
    sub = req.join(nxt, "row_ix", "left").select("row_ix", F.when(k == 0, F.concat(F.lit("other"), "uid")).when(k == 1, F.col("nxt")).otherwise(F.col("uid")).alias("u"),
                                                 q.alias("quality"), F.lit("0.5").alias("toxic"))
    return contracts.submission_violations(sub.withColumnRenamed("u", "uid"), req, TARGETS)


PSEUDO = f"""tc AS (SELECT * FROM (VALUES ('t0', '0'), ('t1', '1'), ('t2', '1')) v(teacher, fold)),
pd AS (SELECT teacher, uid, f.fold AS uf, is_gold, tc.fold AS tf FROM folds f JOIN tc ON f.fold::VARCHAR = tc.fold OR {sql_h("'leak:' || uid || ':' || teacher")} % 60 = 0),
tn AS (SELECT teacher, uid, f.fold FROM folds f, tc WHERE {sql_h("'use:' || uid || ':' || teacher")} % 5 = 0 AND f.fold <> 3)"""


def pseudo(t):
    teachers = t.spark.createDataFrame([("t0", "0", ["3"]), ("t1", "1", ["3"]), ("t2", "1", [])], "teacher string, fold string, excluded array<string>")
    f = t.folds.select("uid", F.col("fold").alias("uf"))
    each = f.withColumn("t", F.explode(F.array(*[F.struct(F.lit(a).alias("teacher"), F.lit(b).alias("tf")) for a, b in (("t0", "0"), ("t1", "1"), ("t2", "1"))]))).select(
        "uid", "uf", "t.*")
    preds = each.where((F.col("uf").cast("string") == F.col("tf")) | (h("leak", F.col("uid"), F.col("teacher")) % 60 == 0)).select("teacher", "uid")
    train = each.where((h("use", F.col("uid"), F.col("teacher")) % 5 == 0) & (F.col("uf") != 3)).select("teacher", "uid")
    return teachers, preds, train


@query("k8_pseudo_label_violations", BASE + f", {PSEUDO} " + """
SELECT DISTINCT * FROM (SELECT 'teachers_share_fold' AS "check", fold AS key FROM tc GROUP BY fold HAVING count(*) > 1 UNION ALL SELECT 'labels_gold', uid FROM pd WHERE is_gold
UNION ALL SELECT 'outside_held_out_fold', uid FROM pd WHERE uf::VARCHAR <> tf UNION ALL SELECT 'labels_own_training_row', uid FROM pd WHERE (teacher, uid) IN (SELECT teacher, uid FROM tn)
UNION ALL SELECT 'labelled_twice', uid FROM pd GROUP BY uid HAVING count(*) > 1 UNION ALL SELECT 'teacher_not_blind', 't2' UNION ALL SELECT 'trained_on_blind_fold', teacher FROM tn WHERE fold = 3
UNION ALL SELECT 'labels_blind_fold', uid FROM pd WHERE uf = 3)""")
def k8(spark, d):
    t = Tables(spark, d)
    teachers, preds, train = pseudo(t)
    return softlabels.pseudo_label_violations(teachers, preds, train, t.folds, "3")


MAN = f"""st AS (SELECT o_orderpriority AS manifest, 's' || o_orderkey AS uid, {sql_h("'mk:' || o_orderkey")} % 400 AS k, floor(o_totalprice)::BIGINT AS bytes FROM orders),
rq AS (SELECT manifest, uid FROM st WHERE k <> 0 OR manifest <> '1-URGENT' UNION ALL SELECT manifest, uid || 'x' FROM st WHERE k = 1 AND manifest = '2-HIGH' UNION ALL SELECT manifest, uid FROM st WHERE k = 2 AND manifest = '3-MEDIUM'),
qr AS (SELECT manifest, uid FROM st WHERE k = 3 AND manifest = '4-NOT SPECIFIED'),
hd AS (SELECT manifest, count(*) AS ns, sum(bytes) AS b FROM st GROUP BY 1)"""


def manifests(t):
    st = t.raw("orders").select(F.col("o_orderpriority").alias("manifest"), F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("uid"),
                                (h("mk", F.col("o_orderkey").cast("string")) % 400).alias("k"), F.floor("o_totalprice").alias("bytes"))
    m, k = F.col("manifest"), F.col("k")
    req = st.where((k != 0) | (m != "1-URGENT")).select("manifest", "uid").unionByName(
        st.where((k == 1) & (m == "2-HIGH")).select("manifest", F.concat("uid", F.lit("x")).alias("uid"))).unionByName(
        st.where((k == 2) & (m == "3-MEDIUM")).select("manifest", "uid"))
    quar = st.where((k == 3) & (m == "4-NOT SPECIFIED")).select("manifest", "uid")
    studies = st.select("manifest", "uid", F.when((k == 4) & (m == "5-LOW"), F.lit("wrong")).otherwise(F.col("uid")).alias("meta_uid"), F.lit("p").alias("policy_hash"),
                        F.array(F.lit(1.0), F.lit(0.0)).alias("slot_mask"), "bytes")
    head = st.groupBy("manifest").agg(F.count(F.lit(1)).alias("n_studies"), F.sum("bytes").alias("byte_total"))
    head = head.join(req.groupBy("manifest").agg(F.count(F.lit(1)).alias("n_requested")), "manifest").withColumn("scope", F.lit("full")).withColumn(
        "policy_hash", F.lit("p")).withColumn("policy_hash_actual", F.lit("p")).withColumn("max_bytes", F.lit(10 ** 15)).withColumn("budget_error", F.lit(None).cast("string"))
    return head, studies, req, quar


@query("k9_manifest_violations", BASE.replace("WITH train AS", f"WITH {MAN}, train AS") + """
SELECT manifest, 7 AS step, 'request_count_mismatch' AS "check", uid AS key FROM rq GROUP BY manifest, uid HAVING count(*) > 1
UNION ALL SELECT manifest, 8, 'unexpected_study', uid FROM st WHERE (manifest, uid) NOT IN (SELECT manifest, uid FROM rq) UNION ALL SELECT manifest, 9, 'requested_scope_incomplete', uid FROM qr
UNION ALL SELECT manifest, 9, 'requested_scope_incomplete', uid FROM rq WHERE (manifest, uid) NOT IN (SELECT manifest, uid FROM st) UNION ALL SELECT manifest, 10, 'invalid_study_uid', uid FROM st WHERE k = 4 AND manifest = '5-LOW'""")
def k9(spark, d):
    return manifest.manifest_violations(*manifests(Tables(spark, d)))


@query("k9_manifest_ready", """SELECT DISTINCT o_orderpriority AS manifest, false AS ready, CASE o_orderpriority WHEN '1-URGENT' THEN 'unexpected_study' WHEN '2-HIGH' THEN 'requested_scope_incomplete' WHEN '3-MEDIUM' THEN 'request_count_mismatch'
  WHEN '4-NOT SPECIFIED' THEN 'requested_scope_incomplete' ELSE 'invalid_study_uid' END AS reason FROM orders""")
def k9_ready(spark, d):
    head, studies, req, quar = manifests(Tables(spark, d))
    return manifest.manifest_ready(head, manifest.manifest_violations(head, studies, req, quar))


@query("k10_label_table_violations", BASE + f"""
SELECT 'invalid_training_mask_or_target' AS "check", uid, target FROM (SELECT uid, target, CASE WHEN {sql_h("'k10:' || target || ':' || uid")} % 30 = 0 THEN 0.5 ELSE mask END AS mask, y FROM cells)
WHERE mask NOT IN (0, 1) OR (mask > 0 AND (y IS NULL OR y NOT IN (0, 1)))""")
def k10(spark, d):
    cells = Tables(spark, d).cells
    return labels.label_table_violations(cells.withColumn("mask", F.when(h("k10", F.col("target"), F.col("uid")) % 30 == 0, 0.5).otherwise(F.col("mask"))))


@query("k11_metric_mismatch", BASE + "," + auc_sql("model, target", "scored") + """
SELECT 'reported_metrics_mismatch' AS "check", model, target FROM aucs WHERE model = 'm2' OR (model = 'm3' AND target = 'toxic')""")
def k11(spark, d):
    per = auc.target_auc(Tables(spark, d).scored, ["model", "target"]).select("model", "target", F.col("auc").alias("metric"))
    told = per.where("NOT (model = 'm3' AND target = 'toxic')").withColumn("metric", F.col("metric") + F.when(F.col("model") == "m2", 1e-6).otherwise(1e-10))
    return contracts.metric_mismatch(per, told, ["model", "target"])


RULE = """d AS (SELECT c_nationkey AS key, avg(c_acctbal) FILTER (c_mktsegment = 'BUILDING') / 1e5 - 0.045 AS g, avg(c_acctbal) / 1e6 - 0.002 AS w, min(c_acctbal) / 1e4 AS lo, count(*) FILTER (c_mktsegment = 'BUILDING') AS n FROM customer GROUP BY 1)"""


@query("k12_promotion_rules", f"WITH {RULE} " + """
SELECT key, coalesce(g >= 0 AND w >= 0.002 AND lo >= -0.03, false) AS candidate, CASE WHEN n > 0 AND g >= 0.001 AND lo > -0.05 THEN 'passes_this_fold_only' ELSE 'not_supported' END AS status FROM d""")
def k12(spark, d):
    c = Tables(spark, d).raw("customer")
    b = F.col("c_mktsegment") == "BUILDING"
    m = c.groupBy(F.col("c_nationkey").alias("key")).agg(
        (F.avg(F.when(b, F.col("c_acctbal"))) / 1e5 - 0.045).alias("g"), (F.avg("c_acctbal") / 1e6 - 0.002).alias("w"), (F.min("c_acctbal") / 1e4).alias("lo"), F.count_if(b).alias("n"))
    return m.select("key", contracts.promote_candidate(F.col("g"), F.col("w"), F.col("lo")).alias("candidate"),
                    contracts.rule_status(F.col("n"), F.col("g"), F.col("lo"), 0.001, -0.05).alias("status"))


@query("k12_all_folds_positive", BASE + ", sf AS (SELECT s.*, f.fold FROM scored s JOIN folds f USING (uid))," + auc_sql("fold, model, target", "sf") + """
, dl AS (SELECT fold, avg(d) AS delta FROM (SELECT fold, target, max(auc) FILTER (model = 'm1') - max(auc) FILTER (model = 'm2') AS d FROM aucs GROUP BY 1, 2) GROUP BY 1)
SELECT bool_and(delta > 0) AS all_positive, true AS secondary_ok, round(min(delta), 9) AS ci_low, bool_and(delta > 0) AND min(delta) > 0 AS passed FROM dl""")
def k12_folds(spark, d):
    t = Tables(spark, d)
    per = auc.auc_delta(t.scored.join(t.folds.select("uid", "fold"), "uid"), "m1", "m2", ["fold", "target"]).groupBy("fold").agg(F.avg("delta").alias("delta"))
    out = contracts.all_folds_positive(per, per.agg(F.min("delta").alias("low")))
    return out.withColumn("ci_low", r9("ci_low"))


@query("k13_gate_rollup", """
WITH g AS (SELECT user_id AS run, event_id, CASE WHEN event_type = 'error' AND value > 50 THEN 'FAIL:value' WHEN event_type = 'purchase' AND value > 30 THEN 'BLOCKED' ELSE 'PASS' END AS s FROM events)
SELECT run, CASE WHEN bool_or(s LIKE 'FAIL%') THEN 'FAIL' WHEN bool_or(s = 'BLOCKED') THEN 'BLOCKED' ELSE 'PASS' END AS overall FROM g GROUP BY 1""")
def k13(spark, d):
    e = F.col("event_type")
    s = F.when((e == "error") & (F.col("value") > 50), "FAIL:value").when((e == "purchase") & (F.col("value") > 30), "BLOCKED").otherwise("PASS")
    return contracts.gate_rollup(Tables(spark, d).raw("events").select(F.col("user_id").alias("run"), s.alias("status")), ["run"])


RUNS = "r AS (SELECT o_orderkey AS run, ['real', 'synthetic', 'fake', 'other'][o_orderkey % 4 + 1] AS kind, CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice / 1e6 END AS auc, (o_orderkey % 7)::BIGINT AS nd, ['PASS', 'FAIL', 'BLOCKED'][o_orderkey % 3 + 1] AS audit FROM orders)"


def runs(t):
    k = F.col("o_orderkey")

    def pick(values, n):
        return F.get(F.array(*[F.lit(v) for v in values]), (k % n).cast("int"))

    return t.raw("orders").select(k.alias("run"), pick(["real", "synthetic", "fake", "other"], 4).alias("kind"), F.when(k % 5 > 0, F.col("o_totalprice") / 1e6).alias("macro_auc"),
                                  (k % 7).alias("n_defined"), pick(["PASS", "FAIL", "BLOCKED"], 3).alias("audit"))


@query("k13_review_blockers", f"WITH {RUNS} " + """
SELECT run, concat_ws(',', CASE WHEN kind <> 'real' THEN 'metrics_not_real' END, CASE WHEN auc IS NULL THEN 'macro_auc_undefined' END, CASE WHEN audit <> 'PASS' THEN 'audit_' || audit END) AS blockers,
  kind = 'real' AND auc IS NOT NULL AND audit = 'PASS' AS champion FROM r""")
def k13_blockers(spark, d):
    out = contracts.review_blockers(runs(Tables(spark, d)).withColumn("source_ok", F.lit(True)).withColumn("outputs_finite", F.lit(True)))
    return out.select("run", F.array_join("blockers", ",").alias("blockers"), "champion")


@query("k14_metric_kind", f"WITH {RUNS} " + """
SELECT * FROM (SELECT CASE WHEN kind IN ('synthetic', 'fake') THEN 'synthetic_metrics' WHEN auc IS NOT NULL AND nd = 0 THEN 'macro_without_defined_class' WHEN kind <> 'real' THEN 'kind_not_real' END AS "check", run FROM r) WHERE "check" IS NOT NULL""")
def k14(spark, d):
    return contracts.metric_kind_violations(runs(Tables(spark, d)))
