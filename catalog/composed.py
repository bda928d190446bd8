"""Whole jobs composed from the operators."""

from pyspark.sql import functions as F

from catalog import query
from catalog.aggregates import AUC_SQL, PAIRED_END, PAIRED_ROWS, auc_sql, exact_sql
from catalog.base import BASE, SEED, SLOTS, TARGETS, Tables, h, r9, sql_h
from catalog.joins import COVERED, covered
from catalog.ordered import DEAL, GSPLIT, HBASE, RBASE, SLICE_SQL, unique_headers
from catalog.scalars import UNIT, VEC, vec
from catalog.scans import ENV_SQL, envelopes
from tallyfold.functions.hashing import resume_key
from tallyfold.operators import contracts, labels, series
from tallyfold.plans import folds as fold_plans
from tallyfold.plans import labels as label_plans
from tallyfold.plans import review
from tallyfold.scale import attach


@query("p1_canonical_report", BASE + f", {ENV_SQL} " + """
, c AS (SELECT e.uid, e.target, CASE WHEN trim(g.v) <> '' THEN (trim(g.v) IN ('0', '1'))::INT ELSE e.mask END AS mask FROM envc e LEFT JOIN gold_text g ON g.uid = e.uid AND g.target = e.target)
SELECT (SELECT count(*) FROM env WHERE reason IS NULL) AS kept, (SELECT count(*) FROM env WHERE reason IS NOT NULL) AS rejected, (SELECT count(*) FROM c WHERE mask > 0) AS supervised_cells""")
def p1(spark, d):
    t = Tables(spark, d)
    return label_plans.canonical_labels(envelopes(t), t.train, TARGETS)["report"]


@query("p1_training_rows", BASE + f", {ENV_SQL} " + """
SELECT uid, count(*) AS n_targets, round(sum(mask), 6) AS masked_in FROM (SELECT e.uid, CASE WHEN trim(g.v) <> '' THEN (trim(g.v) IN ('0', '1'))::INT::DOUBLE ELSE e.mask END AS mask FROM envc e LEFT JOIN gold_text g ON g.uid = e.uid AND g.target = e.target) GROUP BY 1""")
def p1_rows(spark, d):
    t = Tables(spark, d)
    rows = labels.training_rows(label_plans.canonical_labels(envelopes(t), t.train, TARGETS)["cells"], "v1")
    total = F.aggregate(F.map_values("y_mask"), F.lit(0.0), lambda a, v: a + v)
    return rows.select("uid", F.size("targets").cast("long").alias("n_targets"), F.round(total, 6).alias("masked_in"))


@query("p2_numeric_training_labels", BASE + f", {ENV_SQL} " + """
SELECT uid, 'weak' AS source, target, y, mask, weight FROM envc WHERE uid NOT IN (SELECT uid FROM gold) UNION ALL
SELECT uid, 'gold', target, y, (y IS NOT NULL)::INT::DOUBLE, (y IS NOT NULL)::INT::DOUBLE FROM gold""")
def p2(spark, d):
    t = Tables(spark, d)
    return label_plans.numeric_training_labels(envelopes(t), t.train, TARGETS, strict=False)


@query("p2_numeric_label_violations", BASE + f", {ENV_SQL} " + """
SELECT 'invalid_weak_label_row' AS "check", CASE WHEN k IN (0, 1) THEN '' ELSE uid END AS key FROM env WHERE reason IS NOT NULL""")
def p2_bad(spark, d):
    return labels.numeric_label_violations(labels.tag_envelopes(envelopes(Tables(spark, d))))


@query("p3_make_folds", RBASE + f", {DEAL}, {GSPLIT} " + """
SELECT f.uid, d.fold, f.is_gold, coalesce(g.gold_split, 'weak') AS gold_split, f.group_id FROM folds f JOIN dealt d USING (group_id) LEFT JOIN gs g ON g.uid = f.uid""")
def p3(spark, d):
    return fold_plans.make_folds(Tables(spark, d).train, TARGETS, n_folds=5, seed=SEED)["folds"]


@query("p4_all_gold_trainable", BASE + "SELECT uid, fold FROM folds WHERE group_id NOT IN (SELECT group_id FROM folds WHERE is_gold)")
def p4(spark, d):
    return fold_plans.all_gold_holdout(Tables(spark, d).folds)["trainable"].select("uid", "fold")


@query("p5_soft_mean_labels", BASE + """
, common AS (SELECT uid FROM (SELECT DISTINCT source, uid FROM sources) GROUP BY 1 HAVING count(*) = 3),
o AS (SELECT uid, target, round(avg(p), 6) AS p FROM sources WHERE uid IN (SELECT uid FROM common) AND uid IN (SELECT uid FROM folds WHERE NOT is_gold) GROUP BY 1, 2)
SELECT 'output' AS role, 'soft-mean' AS name, (SELECT count(*) FROM o) AS n_rows UNION ALL SELECT 'input', 'sources', (SELECT count(*) FROM sources)""")
def p5(spark, d):
    t = Tables(spark, d)
    return label_plans.soft_mean_labels(t.sources, t.folds)["provenance"].select("role", "name", "n_rows")


@query("p6_available_mean_labels", BASE + """
, ids AS (SELECT DISTINCT uid FROM sources WHERE uid NOT IN (SELECT uid FROM folds WHERE is_gold)), m AS (SELECT i.uid, t.target, (SELECT avg(p) FROM sources s WHERE s.uid = i.uid AND s.target = t.target) AS p FROM ids i, tgt t)
SELECT count(DISTINCT uid) AS n_rows, count(*) FILTER (p IS NULL) AS masked_cells FROM m""")
def p6(spark, d):
    t = Tables(spark, d)
    return label_plans.available_mean_labels(t.sources, t.folds.where("is_gold"), TARGETS)["report"]


TEACH = f"""tp AS (SELECT CASE fold WHEN 0 THEN 't0' ELSE 't1' END AS teacher, uid, target, p FROM preds JOIN folds USING (uid) WHERE NOT is_gold AND ((fold = 0 AND model = 'm1') OR (fold = 1 AND model = 'm2')))"""


@query("p7_pseudo_labels", BASE + f", {TEACH} " + """
SELECT tp.uid, tp.target, round(CASE WHEN s.p IS NULL THEN tp.p ELSE 0.4::DOUBLE * s.p + 0.6::DOUBLE * tp.p END, 6) AS p FROM tp LEFT JOIN (SELECT * FROM sources WHERE source = 's1') s USING (uid, target)""")
def p7(spark, d):
    return _pseudo(spark, d)["cells"]


def _pseudo(spark, d):
    t = Tables(spark, d)
    f = t.folds.where("NOT is_gold AND fold IN (0, 1)").select("uid", "fold")
    preds = t.preds.join(f, "uid").where("(fold = 0 AND model = 'm1') OR (fold = 1 AND model = 'm2')").select(
        F.when(F.col("fold") == 0, "t0").otherwise("t1").alias("teacher"), "uid", "target", "p")
    teachers = spark.createDataFrame([("t0", "0", ["4"]), ("t1", "1", ["4"])], "teacher string, fold string, excluded array<string>")
    train = t.folds.where("fold IN (2, 3)").select(F.lit("t0").alias("teacher"), "uid")
    return label_plans.pseudo_labels(preds, teachers, train, t.sources.where("source = 's1'"), t.folds, alpha=0.4, blind_to="4")


@query("p7_pseudo_coverage", BASE + f", {TEACH}, " + """b AS (SELECT * FROM sources WHERE source = 's1'), r AS (
  SELECT (SELECT count(DISTINCT uid) FROM tp) AS n_rows, (SELECT count(DISTINCT uid) FROM tp WHERE uid NOT IN (SELECT uid FROM b)) AS rows_without_base,
    '0,1' AS folds_covered, (SELECT count(*) FROM tp JOIN b USING (uid, target) WHERE b.p IS NOT NULL) AS cells_with_base)
SELECT teacher, substr(teacher, 2) AS held_out_fold, '4' AS excluded_folds, count(DISTINCT uid) AS teacher_rows, any_value(r.n_rows) AS n_rows, any_value(rows_without_base) AS rows_without_base, any_value(folds_covered) AS folds_covered, any_value(cells_with_base) AS cells_with_base
FROM tp, r GROUP BY 1""")
def p7_coverage(spark, d):
    out = _pseudo(spark, d)
    rows = attach(out["provenance"].withColumnRenamed("n_rows", "teacher_rows"), out["report"])
    return rows.withColumns({c: F.array_join(c, ",") for c in ("excluded_folds", "folds_covered")})


@query("p8_review_decision", BASE + f", {COVERED} " + """
, two AS (SELECT c.uid, c.target, c.model, c.p, l.y, 'weak' AS split FROM cov c JOIN folds f USING (uid) JOIN cells l USING (uid, target) WHERE l.mask > 0 AND model IN ('m1', 'm2') AND fold = 2 AND gold_split <> 'eval' AND c.uid IN (SELECT uid FROM cov WHERE model = 'm2')),
""" + exact_sql("two", 2000, "split") + PAIRED_ROWS + PAIRED_END.replace("SELECT pt.split,", ", fin AS (SELECT pt.split,", 1) + """)
SELECT *, CASE WHEN n_paired > 0 AND delta >= 0.002 AND ci_low > 0 THEN 'passes_this_fold_only' ELSE 'not_supported' END AS status FROM fin""")
def p8(spark, d):
    t = Tables(spark, d)
    f = t.folds.select("uid", "fold", "gold_split")
    ev = F.col("gold_split") == "eval"
    p = covered(t).join(f, "uid").where("model IN ('m1', 'm2')").where(ev | (F.col("fold") == 2))
    # a gold row the control lacks would be an error, so complete the gold side from the full table
    full = t.preds.join(f, "uid").where("model IN ('m1', 'm2')").where(ev)
    p = p.where(~ev).unionByName(full).withColumn("split", F.when(ev, "gold").otherwise("weak")).select("model", "split", "uid", "target", "p")
    rule = {"split": "weak", "min_delta": 0.002, "ci95_lower_gt": 0.0}
    out = review.review_model(p, t.cells, t.folds, "2", TARGETS, new="m1", old="m2", rule=rule, seed=SEED)["decision"]
    return out.select("split", *[r9(c).alias(c) for c in ("delta", "ci_low", "ci_high")], "n_boot", "n_paired", "status")


@query("p9_source_audit_pearson", BASE + """
, common AS (SELECT uid FROM (SELECT DISTINCT source, uid FROM sources) GROUP BY 1 HAVING count(*) = 3), s AS (SELECT * FROM sources WHERE p IS NOT NULL AND uid IN (SELECT uid FROM common) AND uid NOT IN (SELECT uid FROM gold))
SELECT a.target, a.source AS source_a, b.source AS source_b, round(corr(a.p, b.p), 3) AS r, count(*) AS n FROM s a JOIN s b ON a.uid = b.uid AND a.target = b.target AND a.source < b.source GROUP BY 1, 2, 3""")
def p9(spark, d):
    t = Tables(spark, d)
    src = t.sources
    out = label_plans.audit_sources(t.states, src, t.gold, "s1")["pearson"]
    return out


POLICY_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS policy, uid, target, CASE state " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + " END::DOUBLE AS p, y FROM states JOIN gold USING (uid, target) WHERE y IN (0, 1)"
    for name, table in labels.POLICIES.items())


@query("p9_source_audit_policies", BASE + f", every AS ({POLICY_SQL}), pol AS (SELECT * FROM every WHERE p IS NOT NULL)," + auc_sql("policy, target", "pol") + """
SELECT policy, target, n AS n_scored, round(auc, 4) AS auc FROM aucs""")
def p9_policies(spark, d):
    t = Tables(spark, d)
    return label_plans.audit_sources(t.states, t.sources, t.gold, "s1")["policies"]


@query("p10_ranking_cases", BASE + """
, one AS (SELECT * FROM scored WHERE model = 'm1' AND y IN (0, 1)),
c AS (SELECT a.target, a.uid AS pu, b.uid AS nu, CASE WHEN a.p < b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END::DOUBLE AS e FROM one a JOIN one b ON a.target = b.target AND a.y = 1 AND b.y = 0),
u AS (SELECT target, pu AS uid, avg(e) AS burden FROM c GROUP BY 1, 2 UNION ALL SELECT target, nu, avg(e) FROM c GROUP BY 1, 2),
r AS (SELECT target, uid, (rank() OVER (PARTITION BY target ORDER BY p) + (count(*) OVER (PARTITION BY target, p) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY target) AS rr FROM one)
SELECT target, uid, round(burden, 9) AS burden, round(rr, 9) AS reference_rank, (n_chars > 2000) AS long_report FROM u JOIN r USING (target, uid) JOIN train USING (uid)""")
def p10(spark, d):
    t = Tables(spark, d)
    quality = t.train.select("uid", (F.col("n_chars") > 2000).alias("long_report"))
    out = review.ranking_diagnostic(t.preds, t.cells, "m1", ["m2", "m3"], {"quality": "toxic", "toxic": "quality"}, quality)["cases"]
    return out.select("target", "uid", r9("burden").alias("burden"), r9("reference_rank").alias("reference_rank"), "long_report")


@query("p10_quality_strata", BASE + """, one AS (SELECT s.*, f.flag, f.value FROM scored s JOIN (
  SELECT uid, 'long_report' AS flag, (n_chars > 2000)::VARCHAR AS value FROM train UNION ALL SELECT uid, 'odd_site', (site IN ('src1', 'src3'))::VARCHAR FROM train) f USING (uid) WHERE model = 'm1' AND y IN (0, 1)),""" + auc_sql("target, flag, value", "one") + """
SELECT target, flag, value, n, n_pos, n_neg, round(auc, 9) AS auc FROM aucs""")
def p10_strata(spark, d):
    t = Tables(spark, d)
    quality = t.train.select("uid", (F.col("n_chars") > 2000).alias("long_report"), F.col("site").isin("src1", "src3").alias("odd_site"))
    out = review.ranking_diagnostic(t.preds, t.cells, "m1", ["m2", "m3"], {"quality": "toxic", "toxic": "quality"}, quality)["quality_strata"]
    return out.select("target", "flag", "value", "n", "n_pos", "n_neg", r9("auc").alias("auc"))


TWO_FOLDS = """two AS (SELECT s.*, f.fold::VARCHAR AS fold, f.group_id, t.n_chars > 2000 AS long FROM scored s JOIN folds f USING (uid) JOIN train t USING (uid) WHERE f.fold IN (0, 1) AND s.split = 'weak' AND s.model IN ('m1', 'm2') AND s.y IN (0, 1))"""


@query("p11_two_fold_deltas", BASE + f", {TWO_FOLDS}, inside AS (SELECT * FROM two WHERE long)," + exact_sql("two", 2000, "fold", unit="group_id") + """
, rows AS (SELECT two.fold, b, model, target, y, p, w FROM two JOIN w ON two.group_id = w.group_id AND two.fold = w.fold),
pairs AS (SELECT 'all' AS part, * FROM two UNION ALL SELECT 'inside', * FROM inside),
point AS (SELECT part, fold, model, target, (SELECT sum(CASE WHEN a.p > z.p THEN 1.0 WHEN a.p = z.p THEN 0.5 ELSE 0 END)::DOUBLE / count(*) FROM pairs a, pairs z WHERE a.part = k.part AND z.part = k.part AND a.fold = k.fold AND z.fold = k.fold
  AND a.model = k.model AND z.model = k.model AND a.target = k.target AND z.target = k.target AND a.y = 1 AND z.y = 0) AS auc FROM (SELECT DISTINCT part, fold, model, target FROM pairs) k),
per AS (SELECT part, fold, avg(d) AS d FROM (SELECT part, fold, target, max(auc) FILTER (model = 'm1') - max(auc) FILTER (model = 'm2') AS d FROM point GROUP BY 1, 2, 3) GROUP BY 1, 2),
""" + auc_sql("fold, b, model, target", "rows", "w") + """
, dd AS (SELECT b, fold, target, max(auc) FILTER (model = 'm1') - max(auc) FILTER (model = 'm2') AS dl FROM aucs GROUP BY 1, 2, 3),
kept AS (SELECT b, avg(dl) AS delta FROM dd GROUP BY 1 HAVING count(dl) = (SELECT count(*) FROM (SELECT DISTINCT fold, target FROM two))),
ci AS (SELECT quantile_cont(delta, 0.025) AS lo, quantile_cont(delta, 0.975) AS hi, count(*) AS n_boot FROM kept)
SELECT fold, round(d, 9) AS delta, round((SELECT d FROM per i WHERE i.part = 'inside' AND i.fold = per.fold), 9) AS secondary, round(lo, 9) AS ci_low, round(hi, 9) AS ci_high, n_boot,
  (SELECT bool_and(CASE part WHEN 'all' THEN d > 0 ELSE coalesce(d >= 0, false) END) FROM per) AND lo > 0 AND n_boot >= 1900 AS passed
FROM per, ci WHERE part = 'all'""")
def p11(spark, d):
    t = Tables(spark, d)
    f = t.folds.where("fold IN (0, 1)").select("uid", F.col("fold").cast("string").alias("fold"), "group_id")
    rows = t.scored.where("split = 'weak'").join(f, "uid").join(t.train.select("uid", "n_chars"), "uid")
    out = review.two_fold_review(rows, "m1", "m2", seed=SEED, secondary=F.col("n_chars") > 2000, strict=False)
    decided = attach(out["per_fold"], out["decision"].select("ci_low", "ci_high", "n_boot", "passed"))
    return decided.select("fold", *[r9(c).alias(c) for c in ("delta", "secondary", "ci_low", "ci_high")], "n_boot", "passed")


@query("p12_blend_screen", BASE + """
, mm AS (SELECT uid, target, avg(p) AS p FROM preds WHERE model IN ('m2', 'm3') GROUP BY 1, 2), rd AS (SELECT uid, target, p FROM preds WHERE model = 'm1'),
ra AS (SELECT uid, target, (rank() OVER (PARTITION BY target ORDER BY p) + (count(*) OVER (PARTITION BY target, p) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY target) AS r FROM rd),
rb AS (SELECT uid, target, (rank() OVER (PARTITION BY target ORDER BY p) + (count(*) OVER (PARTITION BY target, p) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY target) AS r FROM mm),
ev AS (SELECT model AS candidate, uid, target, p FROM preds WHERE model IN ('m1', 'm2', 'm3') UNION ALL SELECT 'member_mean', * FROM mm UNION ALL SELECT 'rank_blend', uid, target, 0.5::DOUBLE * ra.r + 0.5::DOUBLE * rb.r FROM ra JOIN rb USING (uid, target)),
es AS (SELECT ev.*, y FROM ev JOIN cells USING (uid, target) WHERE mask > 0),""" + AUC_SQL.format(keys="candidate, target", src="es", w="1") + """
, ma AS (SELECT candidate, avg(auc) AS m, count(auc) AS n FROM aucs GROUP BY 1) SELECT candidate, round(m, 6) AS macro_auc, n AS n_defined, round(m - (SELECT m FROM ma WHERE candidate = 'm1'), 6) AS vs_reader FROM ma""")
def p12(spark, d):
    t = Tables(spark, d)
    out = review.blend_screen(t.preds, t.cells, "m1", ["m2", "m3"])
    return out.select("candidate", F.round("macro_auc", 6).alias("macro_auc"), "n_defined", F.round("vs_reader", 6).alias("vs_reader"))


@query("p13_final_submission", BASE + f"""
, mm AS (SELECT uid, target, avg(p) AS p FROM preds WHERE model IN ('m1', 'm2') AND {sql_h("'gone:' || uid")} % 12 > 0 GROUP BY 1, 2),
fi AS (SELECT t.uid, g.target, coalesce(mm.p, (SELECT avg(q.p) FROM mm q WHERE q.target = g.target)) AS p FROM train t CROSS JOIN tgt g LEFT JOIN mm ON mm.uid = t.uid AND mm.target = g.target)
SELECT fi.uid, round(max(CASE WHEN target = 'toxic' THEN fi.p END), 9) AS toxic, max(m3.p) FILTER (target = 'quality') AS quality FROM fi JOIN (SELECT uid, target, p FROM preds WHERE model = 'm3') m3 USING (uid, target) GROUP BY 1""")
def p13(spark, d):
    t = Tables(spark, d)
    p = t.preds.where((F.col("model") == "m3") | (h("gone", F.col("uid")) % 12 > 0))
    out = review.final_submission(p, t.train, TARGETS, ["m1", "m2"], reader="m3", mode="route", from_members=["toxic"])
    return out.select("uid", r9("toxic").alias("toxic"), "quality")


@query("p13_submission_is_valid", "SELECT count(*) = -1 AS broken FROM documents")
def p13_valid(spark, d):
    from tallyfold.scale import ordinal_rank
    t = Tables(spark, d)
    sub = review.final_submission(t.preds, t.train, TARGETS, ["m1", "m2"], reader="m3", mode="blend")
    req = ordinal_rank(t.train.select("uid"), [], [F.col("uid")], "row_ix")
    rows = ordinal_rank(sub, [], [F.col("uid")], "row_ix")
    return contracts.submission_violations(rows, req, TARGETS).agg((F.count(F.lit(1)) > 0).alias("broken"))


PEND = f"""pn AS (SELECT uid, doc_id, report, {sql_h("'dn:' || uid")} % 4 = 0 AS done, length(report) > 4096 AS oversize, {sql_h("'xb:' || uid")} % 8 AS k FROM train)"""


@query("p14_extraction_batch", BASE + f", {PEND} " + """
SELECT uid, CASE WHEN reason IS NULL THEN 'ok' ELSE 'quarantine' END AS status, reason FROM (SELECT uid, CASE WHEN oversize THEN 'report_exceeds_context' WHEN k = 0 THEN 'no_reply' WHEN k = 1 THEN 'truncated_response' WHEN k = 2 THEN 'invalid_json'
  WHEN k = 3 THEN 'quality:evidence_not_in_report;toxic:evidence_not_in_report' WHEN k = 4 THEN 'missing_targets:toxic' END AS reason FROM pn WHERE NOT done)""")
def p14(spark, d):
    """Replies are built from the reports themselves: quotes, missing targets, cut-off and broken JSON."""
    t = Tables(spark, d)
    lit = F.lit
    key = resume_key(F.col("uid"), F.col("report"), lit("m"), lit("r"), lit("p"), lit("o"), lit("e"))
    done = t.train.where(h("dn", F.col("uid")) % 4 == 0).select(key.alias("resume_key"), lit("ok").alias("status"))
    # no newline pairs in these reports: one paragraph each, so an oversize report cannot be split
    pending = label_plans.pending_reports(t.train, done, model="m", revision="r", prompt_hash="p", ontology="o", evidence_policy="e",
                                          context_tokens=1536, output_tokens=256)
    k = h("xb", F.col("uid")) % 8
    quote = F.when(k == 3, lit("☃ nowhere")).otherwise(F.substring("report", 1, 15))

    def finding():
        return F.struct(lit("criterion_positive").alias("state"), quote.alias("evidence_span"), lit("x").alias("criterion_mapping"))

    both = F.to_json(F.struct(F.col("uid").alias("StudyInstanceUID"), F.struct(finding().alias("quality"), finding().alias("toxic")).alias("targets")))
    one = F.to_json(F.struct(F.col("uid").alias("StudyInstanceUID"), F.struct(finding().alias("quality")).alias("targets")))
    replies = t.train.where(k != 0).select(
        "uid", lit(0).alias("chunk"), F.when(k == 2, lit("{broken")).when(k == 4, one).otherwise(both).alias("content"),
        lit(None).cast("string").alias("reasoning_content"), F.when(k == 1, lit("length")).otherwise(lit("stop")).alias("finish_reason"))
    return label_plans.extraction_batch(pending, replies, TARGETS).select("uid", "status", "reason")


@query("p15_series_plan", HBASE + f", {SLICE_SQL} " + """
, sl AS (SELECT DISTINCT study, series FROM headers), gp AS (SELECT study, series, proj - lag(proj) OVER (PARTITION BY study, series ORDER BY position) AS gap FROM ord),
ag AS (SELECT study, series, median(gap) AS md FROM gp WHERE gap IS NOT NULL GROUP BY 1, 2), ex AS (SELECT study, series, count(*) AS n, count(proj) AS np, min(mode) AS mode FROM ord GROUP BY 1, 2),
ct AS (SELECT study, series, 12 - count(DISTINCT round_even(CASE WHEN n >= 3 THEN greatest(1, least(n - 2, x * (n - 1))) ELSE x * (n - 1) END, 0)::INT)::INT AS dc FROM ex, (SELECT 0.15::DOUBLE + 0.7::DOUBLE * i / 11 AS x FROM range(12) r(i)) GROUP BY 1, 2)
SELECT s.study, g.slot, CASE WHEN g.slot = 2 THEN s.series END AS series, g.slot = 2 AS present, CASE WHEN g.slot = 2 THEN e.mode END AS mode, CASE WHEN g.slot = 2 THEN dc END AS duplicate_centers,
  CASE WHEN g.slot = 2 AND e.n >= 2 AND np = e.n THEN round(md, 4) END AS spacing_median
FROM sl s CROSS JOIN (SELECT unnest(range(5))::INT AS slot) g JOIN ex e USING (study, series) LEFT JOIN ag USING (study, series) JOIN ct USING (study, series)""")
def p15(spark, d):
    t = Tables(spark, d)
    hd = unique_headers(t)
    ser = t.headers.select("study", "series").distinct().select("study", "series", F.lit("Axial").alias("plane"), F.lit("1").alias("fluid"), F.lit("1").alias("fat"), F.lit(0).alias("n"))
    out = series.series_plan(ser, hd, SLOTS, 12)
    return out.select("study", "slot", "series", "present", "mode", "duplicate_centers", "spacing_median")


@query("p16_metadata_values", BASE + """
SELECT 'plane' AS "column", plane AS value, count(*) AS n FROM series GROUP BY 2 UNION ALL SELECT 'fluid', fluid, count(*) FROM series GROUP BY 2 UNION ALL SELECT 'fat', fat, count(*) FROM series GROUP BY 2""")
def p16(spark, d):
    t = Tables(spark, d)
    return label_plans.metadata_audit(t.train, t.series, TARGETS, ["uid", *TARGETS], t.raw("pages"))["values"]


def _slices(t):
    return vec(t).select(F.lit("s").alias("study"), F.col("label").alias("series"), "vec_id", "values", F.lit(1.0).alias("slope"), F.lit(0.0).alias("intercept"), F.lit("MONOCHROME2").alias("photometric"))


@query("p17_slice_values", f"WITH {VEC}, {UNIT} SELECT vec_id, sum(floor(greatest(0, least(255, x * 255)))::INT)::BIGINT AS total FROM q GROUP BY 1")
def p17(spark, d):
    out = series.slice_values(_slices(Tables(spark, d)), "slice")
    return out.select("vec_id", F.aggregate("q", F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))


@query("p17_series_values", f"""WITH {VEC}, w AS (SELECT label, quantile_cont(x, 0.005) AS lo, quantile_cont(x, 0.995) AS hi FROM u GROUP BY 1)
SELECT vec_id, sum(floor(greatest(0, least(255, (greatest(lo, least(hi, x)) - lo) / (hi - lo) * 255)))::INT)::BIGINT AS total FROM u JOIN w USING (label) GROUP BY 1""")
def p17_series(spark, d):
    out = series.slice_values(_slices(Tables(spark, d)), "series")
    return out.select("vec_id", F.aggregate("q", F.lit(0).cast("long"), lambda a, v: a + v).alias("total"))


@query("p17_center_slices", f"""WITH {VEC}, hd AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY (vec_id * 7919) % 100003, vec_id) - 1 AS position, count(*) OVER (PARTITION BY label) AS n FROM v),
ce AS (SELECT label, n, k AS center, CASE WHEN n >= 3 THEN greatest(1.0, least(n - 2, (0.15::DOUBLE + (0.85::DOUBLE - 0.15::DOUBLE) * k / 3) * (n - 1))) ELSE (0.15::DOUBLE + (0.85::DOUBLE - 0.15::DOUBLE) * k / 3) * (n - 1) END AS x FROM (SELECT DISTINCT label, n FROM hd), range(4) r(k)),
cells AS (SELECT label, center, j AS neighbour, greatest(0, least(n - 1, round_even(x, 0)::INT + j - 1)) AS position FROM ce, range(3) r(j)),
used AS (SELECT label, position, string_agg(center || '-' || neighbour, ' ' ORDER BY center, neighbour) AS places FROM cells GROUP BY 1, 2),
px AS (SELECT h.label, h.vec_id, h.n, h.position, u.places, (h.vec_id % 3 = 0) AS bare, unnest(h.vals) AS x, generate_subscripts(h.vals, 1) - 1 AS i FROM hd h JOIN used u ON h.label = u.label AND h.position = u.position),
fx AS (SELECT *, CASE WHEN vec_id % 5 = 0 THEN max(y) OVER (PARTITION BY vec_id) - y ELSE y END AS z FROM (SELECT *, x * 2.0::DOUBLE - 0.5::DOUBLE AS y FROM px)),
cr AS (SELECT * FROM fx WHERE bare OR (i // 8 >= 1 AND i // 8 < 7)),
wi AS (SELECT label, quantile_cont(z, 0.005) AS lo, quantile_cont(z, 0.995) AS hi FROM cr GROUP BY 1)
SELECT label, vec_id, 'instance_number_fallback' AS mode, n::BIGINT AS n_slices, position::INT AS position, places, CASE WHEN bare THEN 'missing_spacing_square_fallback' ELSE 'pixel_spacing_mm' END AS crop_mode, count(*) AS pixels,
  sum(floor(greatest(0, least(255, (greatest(lo, least(hi, z)) - lo) / (hi - lo) * 255)))::INT)::BIGINT AS total FROM cr JOIN wi USING (label) GROUP BY ALL""")
def p17_centers(spark, d):
    """Four centers a series: slices in order of instance, triplets, crops of 8 x 8 pixels, a window per series."""
    v = vec(Tables(spark, d)).withColumns({"study": F.lit("s"), "series": F.col("label").cast("string"), "path": F.lpad(F.col("vec_id").cast("string"), 12, "0")})
    headers = v.select("study", "series", "path", ((F.col("vec_id") * 7919) % 100003).alias("instance"), *[F.lit(None).cast("array<double>").alias(c) for c in ("iop", "ipp")])
    slices = v.select(
        "study", "series", "path", F.lit(8).alias("rows"), F.lit(8).alias("cols"), F.when(F.col("vec_id") % 3 != 0, F.array(F.lit(25.0), F.lit(20.0))).alias("spacing"),
        F.lit(2.0).alias("slope"), F.lit(-0.5).alias("intercept"), F.when(F.col("vec_id") % 5 == 0, "MONOCHROME1").alias("photometric"), "values")
    out = series.center_slices(headers, slices, 4, intensity="series")
    places = F.array_join(F.transform("places", lambda p: F.concat_ws("-", p["center"].cast("string"), p["neighbour"].cast("string"))), " ")
    return out.select(
        F.col("series").cast("int").alias("label"), F.col("path").cast("long").alias("vec_id"), "mode", F.col("n_slices").cast("long").alias("n_slices"), F.col("position").cast("int").alias("position"),
        places.alias("places"), F.col("crop.mode").alias("crop_mode"), F.size("q").cast("long").alias("pixels"), F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))
