"""Aggregations and scores."""

import math

from pyspark.sql import functions as F

from catalog import query
from catalog.base import BASE, SEED, TARGETS, Tables, h, r9, sql_h, sql_nonempty
from tallyfold.operators import agreement, auc, bootstrap, calibration, dominance, extraction, folds, labels, manifest, poisson, softlabels
from tallyfold.plans import labels as label_plans
from tallyfold.plans import review

# Mann-Whitney by window over the distinct scores of each key
AUC_SQL = """
hist AS (SELECT {keys}, p, sum(CASE WHEN y = 1 THEN {w} ELSE 0 END) AS pos, sum(CASE WHEN y = 0 THEN {w} ELSE 0 END) AS neg, count(*) AS n
         FROM {src} GROUP BY {keys}, p),
steps AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {keys} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM hist),
aucs AS (SELECT {keys}, sum(n)::BIGINT AS n, sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
         CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos::DOUBLE * (below::DOUBLE + neg::DOUBLE / 2)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) END AS auc
         FROM steps GROUP BY {keys})
"""


def auc_sql(keys: str, src: str, w: str = "1") -> str:
    return AUC_SQL.format(keys=keys, src=src, w=w)


@query("d1_metadata_audit", BASE + f"""
SELECT (SELECT count(*) FROM train) AS n_train, (SELECT count(DISTINCT uid) FROM train) AS n_unique_uid,
  (SELECT count(*) FROM train WHERE {sql_nonempty('quality')} AND {sql_nonempty('toxic')}) AS n_gold,
  (SELECT count(*) FROM train WHERE NOT {sql_nonempty('report')}) AS n_missing_report,
  (SELECT count(*) FROM series) AS n_series, (SELECT count(DISTINCT study) FROM series) AS n_series_studies,
  (SELECT count(*) FROM series WHERE fluid = fat) AS n_flags_equal,
  (SELECT count(*) FROM pages) AS n_test, false AS flags_all_equal, true AS columns_match""")
def d1(spark, d):
    t = Tables(spark, d)
    return label_plans.metadata_audit(t.train, t.series, TARGETS, ["uid", *TARGETS], t.raw("pages"))["summary"]


@query("d2_value_counts", BASE + """
SELECT 'plane' AS "column", plane AS value, count(*) AS n FROM series GROUP BY 2 UNION ALL
SELECT 'fluid', fluid, count(*) FROM series GROUP BY 2 UNION ALL SELECT 'fat', fat, count(*) FROM series GROUP BY 2""")
def d2(spark, d):
    return agreement.value_counts(Tables(spark, d).series, ["plane", "fluid", "fat"])


@query("d2_state_counts", BASE + """
SELECT target AS "column", state AS value, count(*) AS n FROM states GROUP BY 1, 2""")
def d2_states(spark, d):
    rows = Tables(spark, d).states
    return rows.groupBy(F.col("target").alias("column"), F.col("state").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query("d3_gold_class_counts", BASE + f"""
SELECT target, count(*) FILTER (v = '1') AS pos, count(*) FILTER (v = '0') AS neg FROM gold_text JOIN folds USING (uid) WHERE is_gold GROUP BY 1""")
def d3(spark, d):
    return labels.gold_class_counts(Tables(spark, d).train, TARGETS)


@query("d4_duplicate_text_groups", BASE + """
SELECT text_hash, n FROM (SELECT sha256(coalesce(report, '')) AS text_hash, count(*) AS n FROM train GROUP BY 1) WHERE n > 1""")
def d4(spark, d):
    return folds.duplicate_text_groups(Tables(spark, d).train, "uid", "report")


@query("d4_duplicate_text_members", BASE + """
, g AS (SELECT text_hash, n FROM (SELECT sha256(coalesce(report, '')) AS text_hash, count(*) AS n FROM train GROUP BY 1) WHERE n > 1 ORDER BY 1 LIMIT 20),
m AS (SELECT g.text_hash, n, uid, row_number() OVER (PARTITION BY g.text_hash ORDER BY uid) AS k FROM g JOIN train ON sha256(coalesce(report, '')) = g.text_hash)
SELECT text_hash, n, string_agg(uid, ',' ORDER BY uid) AS uids FROM m WHERE k <= 8 GROUP BY 1, 2""")
def d4_members(spark, d):
    return folds.duplicate_text_members(Tables(spark, d).train, "uid", "report").withColumn("uids", F.array_join("uids", ","))


@query("d5_leakage_groups", BASE + "SELECT uid, group_id FROM grouped")
def d5(spark, d):
    return folds.leakage_groups(Tables(spark, d).train, "uid", "report")


@query("d6_masked_auc", BASE + "," + auc_sql("model, target", "scored") + """
SELECT model, target, n, n_pos, n_neg, round(auc, 9) AS auc, auc IS NULL AS undefined FROM aucs""")
def d6(spark, d):
    t = Tables(spark, d)
    rows = t.preds.join(t.cells.select("uid", "target", "y", "mask"), ["uid", "target"])
    return auc.target_auc(rows, ["model", "target"], mask="mask").withColumn("auc", r9("auc"))


@query("d6_undefined_auc", BASE + ", onesided AS (SELECT model, target, uid, p, CASE WHEN target = 'toxic' THEN 1.0 ELSE y END AS y FROM scored)," + auc_sql("model, target", "onesided") + """
SELECT model, target, n, n_pos, n_neg, round(auc, 9) AS auc, auc IS NULL AS undefined FROM aucs""")
def d6_undefined(spark, d):
    rows = Tables(spark, d).scored.withColumn("y", F.when(F.col("target") == "toxic", F.lit(1.0)).otherwise(F.col("y")))
    return auc.target_auc(rows, ["model", "target"]).withColumn("auc", r9("auc"))


@query("d7_macro_auc", BASE + "," + auc_sql("model, target", "scored") + """
SELECT model, round(avg(auc), 9) AS macro_auc, count(auc) AS n_defined, count(*) AS n_targets FROM aucs GROUP BY 1""")
def d7(spark, d):
    return auc.macro_auc(auc.target_auc(Tables(spark, d).scored, ["model", "target"]), ["model"]).withColumn("macro_auc", r9("macro_auc"))


@query("d8_rounded_macro", BASE + "," + auc_sql("model, target", "scored") + "SELECT model, round(avg(auc), 4) AS macro FROM aucs GROUP BY 1")
def d8(spark, d):
    return auc.rounded_macro(auc.target_auc(Tables(spark, d).scored, ["model", "target"]), ["model"], "auc")


@query("d9_diagnostics", BASE + """
SELECT model, target, round(avg(-(y * ln(q) + (1 - y) * ln(1 - q))), 9) AS log_loss, round(stddev_pop(p), 9) AS pred_std, round(avg(p), 9) AS pred_mean
FROM (SELECT *, greatest(1e-6::DOUBLE, least((1 - 1e-6)::DOUBLE, p)) AS q FROM scored) GROUP BY 1, 2""")
def d9(spark, d):
    out = auc.diagnostics(Tables(spark, d).scored, ["model", "target"])
    return out.select("model", "target", *[r9(c).alias(c) for c in ("log_loss", "pred_std", "pred_mean")])


@query("d10_split_scores", BASE + "," + auc_sql("model, split, target", "scored") + """
SELECT model, split, round(avg(auc), 9) AS macro_auc, count(auc) AS n_defined, count(*) AS n_targets FROM aucs GROUP BY 1, 2""")
def d10(spark, d):
    t = Tables(spark, d)
    return review.split_scores(t.preds, t.cells)["macro"].withColumn("macro_auc", r9("macro_auc"))


def mixed_sql(columns: str, units: str, n_boot: int) -> str:
    """CTE z3(columns, b, u): a uniform number for each of a table's rows (hash h) and replicates, by the library's 64-bit mix."""
    mod = "18446744073709551616::UHUGEINT"
    return f"""
z0 AS (SELECT {columns}, b, ((h::UHUGEINT + (b + 1)::UHUGEINT * 11400714819323198485::UHUGEINT) % {mod})::UBIGINT AS z FROM {units}, (SELECT unnest(range({n_boot})) AS b)),
z1 AS (SELECT {columns}, b, ((xor(z, z >> 30)::UHUGEINT * 13787848793156543929::UHUGEINT) % {mod})::UBIGINT AS z FROM z0),
z2 AS (SELECT {columns}, b, ((xor(z, z >> 27)::UHUGEINT * 10723151780598845931::UHUGEINT) % {mod})::UBIGINT AS z FROM z1),
z3 AS (SELECT {columns}, b, (xor(z, z >> 31) >> 11)::DOUBLE * 1.1102230246251565e-16 AS u FROM z2)"""


def exact_sql(universe: str, n_boot: int, strata: str = "", seed: int = SEED, unit: str = "uid") -> str:
    """CTEs idx(strata, unit, i, n) and w(strata, b, unit, w): the library's exact multinomial weights, Poisson counts and further draws."""
    s = f"{strata}, " if strata else ""
    part = f"PARTITION BY {strata}" if strata else ""
    tag = f"|| {strata} || ':' " if strata else ""
    on = f"f.{strata} = x.{strata} AND " if strata else ""
    pick = f"x.{strata}, " if strata else ""
    terms = ["1", *[f"m ** {k} / {math.factorial(k)}" for k in range(1, 12)]]
    steps = ", ".join(f"exp(-m) * ({' + '.join(terms[: k + 1])}) AS c{k}" for k in range(12))
    count = " + ".join(f"(u >= c{k})::INT" for k in range(12))
    cuts = ", ".join(f"c{k}" for k in range(12))
    return f"""
idx AS (SELECT {s}{unit}, row_number() OVER ({part} ORDER BY {unit}) - 1 AS i, count(*) OVER ({part}) AS n FROM (SELECT DISTINCT {s}{unit} FROM {universe})),
means AS (SELECT {s}{unit}, n, greatest(0::DOUBLE, 1 - 7::DOUBLE / sqrt(n)) AS m, {sql_h(f"'{seed}:' {tag}|| {unit}")} AS h FROM idx),
units AS (SELECT {s}{unit}, n, h, {steps} FROM means),{mixed_sql(f"{s}{unit}, n, {cuts}", "units", n_boot)},
base AS (SELECT {s}{unit}, n, b, {count} AS w FROM z3),
lacking AS (SELECT {s}b, max(n) AS n, max(n) - sum(w) AS d FROM base GROUP BY {s}b),
fill AS (SELECT {s}b, {sql_h(f"'{seed}:' {tag}|| 'draw:' || b || ':' || k")} % n AS i, count(*) AS w FROM (SELECT *, unnest(range(d::BIGINT)) AS k FROM lacking) GROUP BY ALL),
w AS (SELECT {s}{unit}, b, sum(w)::DOUBLE AS w FROM (SELECT {s}{unit}, b, w FROM base WHERE w > 0 UNION ALL SELECT {pick}x.{unit}, f.b, f.w FROM fill f JOIN idx x ON {on}f.i = x.i) GROUP BY ALL)"""


def poisson_sql(universe: str, n_boot: int, unit: list[str], seed: int = SEED) -> str:
    """CTE w(unit, b, w) with the library's Poisson weights: a 64-bit mix of the unit's hash and the replicate."""
    u = ", ".join(unit)
    label = " || ':' || ".join(f"{c}::VARCHAR" for c in unit)
    steps = " + ".join(f"(u >= {float(c)!r}e0::DOUBLE)::INT" for c in poisson.CDF)
    return f"""
units AS (SELECT {u}, {sql_h(f"'{seed}:' || {label}")} AS h FROM (SELECT DISTINCT {u} FROM {universe})),{mixed_sql(u, "units", n_boot)},
w AS (SELECT {u}, b, {steps} AS w FROM z3)"""


@query("d11_bootstrap_macro", BASE + "," + exact_sql("scored", 2000, seed=7) + ", rows AS (SELECT model, b, target, y, p, w FROM scored JOIN w USING (uid))," + auc_sql("model, b, target", "rows", "w") + """
, m AS (SELECT model, b, avg(auc) AS m FROM aucs GROUP BY 1, 2)
SELECT model, round(avg(m), 9) AS mean, round(quantile_cont(m, 0.025), 9) AS low, round(quantile_cont(m, 0.975), 9) AS high, count(m) AS n_boot FROM m GROUP BY 1""")
def d11(spark, d):
    out = bootstrap.bootstrap_macro(Tables(spark, d).scored, 2000, 7, by=["model"])
    return out.select("model", *[r9(c).alias(c) for c in ("mean", "low", "high")], "n_boot")


PAIRED_ROWS = """
, rows AS (SELECT two.split, b, model, target, y, p, w FROM two JOIN w ON two.uid = w.uid AND two.split = w.split),
""" + auc_sql("split, b, model, target", "rows", "w")
PAIRED_END = """
, mm AS (SELECT split, b, avg(auc) FILTER (model = 'm1') - avg(auc) FILTER (model = 'm2') AS delta FROM aucs GROUP BY 1, 2),
ci AS (SELECT split, quantile_cont(delta, 0.025) AS lo, quantile_cont(delta, 0.975) AS hi, count(delta) AS n_boot FROM mm GROUP BY 1),
pt AS (SELECT split, avg(auc) FILTER (model = 'm1') - avg(auc) FILTER (model = 'm2') AS delta FROM (
  SELECT split, model, target, (SELECT sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END)::DOUBLE / count(*) FROM two a, two b
    WHERE a.split = k.split AND b.split = k.split AND a.model = k.model AND b.model = k.model AND a.target = k.target AND b.target = k.target AND a.y = 1 AND b.y = 0) AS auc
  FROM (SELECT DISTINCT split, model, target FROM two) k) GROUP BY 1)
SELECT pt.split, round(delta, 9) AS delta, round(lo, 9) AS ci_low, round(hi, 9) AS ci_high, n_boot, (SELECT count(DISTINCT uid) FROM two t WHERE t.split = pt.split) AS n_paired
FROM pt JOIN ci USING (split)"""


@query("d12_paired_delta", BASE + ", two AS (SELECT * FROM scored WHERE model IN ('m1', 'm2'))," + exact_sql("two", 2000, "split") + PAIRED_ROWS + PAIRED_END)
def d12(spark, d):
    out = bootstrap.paired_delta(Tables(spark, d).scored, "m1", "m2", 2000, SEED, ["split"])
    return out.select("split", *[r9(c).alias(c) for c in ("delta", "ci_low", "ci_high")], "n_boot", "n_paired")


@query("d12_paired_delta_poisson", BASE + ", two AS (SELECT * FROM scored WHERE model IN ('m1', 'm2'))," + poisson_sql("two", 2000, ["uid"]) + """
, rows AS (SELECT two.split, b, model, target, y, p, w FROM two JOIN w USING (uid)),
""" + auc_sql("split, b, model, target", "rows", "w") + PAIRED_END)
def d12_poisson(spark, d):
    """Independent Poisson weights per study, the same in every stratum, model and target."""
    out = bootstrap.paired_delta(Tables(spark, d).scored, "m1", "m2", 2000, SEED, ["split"], method="poisson")
    return out.select("split", *[r9(c).alias(c) for c in ("delta", "ci_low", "ci_high")], "n_boot", "n_paired")


@query("d13_pair_summary", BASE + """
SELECT a.model, a.target, count(*) AS n_pairs, sum(CASE WHEN a.p < b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END)::DOUBLE AS misordered,
  round(1 - sum(CASE WHEN a.p < b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END)::DOUBLE / count(*), 9) AS identity_auc,
  count(DISTINCT a.uid) AS n_pos, count(DISTINCT b.uid) AS n_neg
FROM scored a JOIN scored b ON a.model = b.model AND a.target = b.target AND a.y = 1 AND b.y = 0 GROUP BY 1, 2""")
def d13(spark, d):
    return auc.pair_summary(Tables(spark, d).scored, ["model", "target"]).withColumn("identity_auc", r9("identity_auc"))


@query("d14_component_comparison", BASE + """
, wide AS (SELECT uid, target, y, max(p) FILTER (model = 'm1') AS r, max(p) FILTER (model = 'm2') AS c2, max(p) FILTER (model = 'm3') AS c3, max(p) FILTER (model = 'm4') AS c4
  FROM scored GROUP BY 1, 2, 3),
pairs AS (SELECT a.target, a.r <= b.r AS rw, a.c2 <= b.c2 AS w2, a.c3 <= b.c3 AS w3, a.c4 <= b.c4 AS w4 FROM wide a JOIN wide b ON a.target = b.target AND a.y = 1 AND b.y = 0)
SELECT target, 'm2' AS component, count(*) FILTER (rw AND NOT w2) AS corrected, count(*) FILTER (NOT rw AND w2) AS broken, NULL::BIGINT AS all_wrong FROM pairs GROUP BY 1
UNION ALL SELECT target, 'm3', count(*) FILTER (rw AND NOT w3), count(*) FILTER (NOT rw AND w3), NULL FROM pairs GROUP BY 1
UNION ALL SELECT target, 'm4', count(*) FILTER (rw AND NOT w4), count(*) FILTER (NOT rw AND w4), NULL FROM pairs GROUP BY 1
UNION ALL SELECT target, '*', NULL, NULL, count(*) FILTER (w2 AND w3 AND w4) FROM pairs GROUP BY 1""")
def d14(spark, d):
    wide = Tables(spark, d).scored.groupBy("uid", "target", "y").pivot("model", ["m1", "m2", "m3", "m4"]).agg(F.first("p"))
    return dominance.component_comparison(wide, ["target"], "m1", ["m2", "m3", "m4"])


GROUPED = """two AS (SELECT s.*, f.fold::VARCHAR AS fold, f.group_id FROM scored s JOIN folds f USING (uid)
  WHERE s.split = 'weak' AND f.fold IN (0, 1) AND s.model IN ('m1', 'm2') AND s.y IN (0, 1))"""


def _two_folds(t):
    f = t.folds.where("fold IN (0, 1)").select("uid", F.col("fold").cast("string").alias("fold"), "group_id")
    return t.scored.where("split = 'weak' AND model IN ('m1', 'm2')").join(f, "uid")


@query("d15_group_bootstrap_delta", BASE + f", {GROUPED}," + exact_sql("two", 2000, "fold", unit="group_id") + """
, rows AS (SELECT two.fold, b, model, target, y, p, w FROM two JOIN w ON two.group_id = w.group_id AND two.fold = w.fold),
""" + auc_sql("fold, b, model, target", "rows", "w") + """
, dd AS (SELECT b, fold, target, max(auc) FILTER (model = 'm1') - max(auc) FILTER (model = 'm2') AS dl FROM aucs GROUP BY 1, 2, 3),
kept AS (SELECT b, avg(dl) AS delta FROM dd GROUP BY 1 HAVING count(dl) = (SELECT count(*) FROM (SELECT DISTINCT fold, target FROM two)))
SELECT round(avg(delta), 9) AS mean, round(quantile_cont(delta, 0.025), 9) AS low, round(quantile_cont(delta, 0.975), 9) AS high, count(*) AS n_boot FROM kept""")
def d15(spark, d):
    out = bootstrap.group_bootstrap_delta(_two_folds(Tables(spark, d)), "m1", "m2", 2000, SEED)
    return out.select(*[r9(c).alias(c) for c in ("mean", "low", "high")], "n_boot")


@query("d15_group_bootstrap_delta_poisson", BASE + f", {GROUPED}," + poisson_sql("two", 2000, ["fold", "group_id"]) + """
, rows AS (SELECT two.fold, b, model, target, y, p, w FROM two JOIN w ON two.group_id = w.group_id AND two.fold = w.fold),
""" + auc_sql("fold, b, model, target", "rows", "w") + """
, dd AS (SELECT b, fold, target, max(auc) FILTER (model = 'm1') - max(auc) FILTER (model = 'm2') AS dl FROM aucs GROUP BY 1, 2, 3),
kept AS (SELECT b, avg(dl) AS delta FROM dd GROUP BY 1 HAVING count(dl) = (SELECT count(*) FROM (SELECT DISTINCT fold, target FROM two)))
SELECT round(avg(delta), 9) AS mean, round(quantile_cont(delta, 0.025), 9) AS low, round(quantile_cont(delta, 0.975), 9) AS high, count(*) AS n_boot FROM kept""")
def d15_poisson(spark, d):
    out = bootstrap.group_bootstrap_delta(_two_folds(Tables(spark, d)), "m1", "m2", 2000, SEED, method="poisson")
    return out.select(*[r9(c).alias(c) for c in ("mean", "low", "high")], "n_boot")


@query("d15_group_bootstrap_auc", BASE + ", one AS (SELECT s.*, f.group_id FROM scored s JOIN folds f USING (uid))," + exact_sql("one", 2000, "target", unit="group_id") + """
, rows AS (SELECT one.model, one.target, b, y, p, w FROM one JOIN w ON one.group_id = w.group_id AND one.target = w.target),
""" + auc_sql("model, b, target", "rows", "w") + """
SELECT model, target, round(avg(auc), 9) AS mean, round(quantile_cont(auc, 0.025), 9) AS low, round(quantile_cont(auc, 0.975), 9) AS high, count(auc) AS n_boot FROM aucs WHERE auc IS NOT NULL GROUP BY 1, 2""")
def d15_auc(spark, d):
    t = Tables(spark, d)
    rows = t.scored.join(t.folds.select("uid", "group_id"), "uid")
    out = bootstrap.group_bootstrap_auc(rows, 2000, SEED, by=["model"])
    return out.select("model", "target", *[r9(c).alias(c) for c in ("mean", "low", "high")], "n_boot")


@query("d15_group_bootstrap_auc_poisson", BASE + ", one AS (SELECT s.*, f.group_id FROM scored s JOIN folds f USING (uid))," + poisson_sql("one", 2000, ["target", "group_id"]) + """
, rows AS (SELECT one.model, one.target, b, y, p, w FROM one JOIN w ON one.group_id = w.group_id AND one.target = w.target),
""" + auc_sql("model, b, target", "rows", "w") + """
SELECT model, target, round(avg(auc), 9) AS mean, round(quantile_cont(auc, 0.025), 9) AS low, round(quantile_cont(auc, 0.975), 9) AS high, count(auc) AS n_boot FROM aucs WHERE auc IS NOT NULL GROUP BY 1, 2""")
def d15_auc_poisson(spark, d):
    t = Tables(spark, d)
    rows = t.scored.join(t.folds.select("uid", "group_id"), "uid")
    out = bootstrap.group_bootstrap_auc(rows, 2000, SEED, by=["model"], method="poisson")
    return out.select("model", "target", *[r9(c).alias(c) for c in ("mean", "low", "high")], "n_boot")


@query("d16_weighted_auc", BASE + ", ww AS (SELECT s.*, CASE WHEN c.weight = 0.15 THEN 3 ELSE 5 END AS w FROM scored s JOIN cells c USING (uid, target))," + auc_sql("model, target", "ww", "w") + """
SELECT model, target, n, n_pos::DOUBLE AS n_pos, n_neg::DOUBLE AS n_neg, round(auc, 9) AS auc FROM aucs""")
def d16(spark, d):
    t = Tables(spark, d)
    rows = t.scored.join(t.cells.select("uid", "target", F.when(F.col("weight") == 0.15, 3).otherwise(5).alias("w")), ["uid", "target"])
    return auc.target_auc(rows, ["model", "target"], weight="w").select("model", "target", "n", "n_pos", "n_neg", r9("auc").alias("auc"))


COMPANION_SQL = """comp AS (SELECT s.*, coalesce(c.y::INT::VARCHAR, 'none') AS companion FROM scored s LEFT JOIN
  (SELECT uid, target, y FROM cells WHERE mask > 0 AND y IN (0, 1)) c ON c.uid = s.uid AND c.target = CASE s.target WHEN 'quality' THEN 'toxic' ELSE 'quality' END)"""


@query("d17_subgroup_auc", BASE + f", {COMPANION_SQL}," + auc_sql("model, target, companion", "comp") + """
SELECT model, target, companion, n, n_pos, n_neg, round(auc, 9) AS auc, auc IS NULL AS undefined FROM aucs""")
def d17(spark, d):
    t = Tables(spark, d)
    rows = auc.with_companion(t.scored, t.cells, {"quality": "toxic", "toxic": "quality"})
    return auc.subgroup_auc(rows, "companion", ["model", "target"]).withColumn("auc", r9("auc"))


@query("d18_case_burden", BASE + """
, c AS (SELECT a.model, a.target, a.uid AS pu, b.uid AS nu, CASE WHEN a.p < b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END::DOUBLE AS e
  FROM scored a JOIN scored b ON a.model = b.model AND a.target = b.target AND a.y = 1 AND b.y = 0)
SELECT model, target, pu AS uid, 1 AS y, round(avg(e), 9) AS burden FROM c GROUP BY 1, 2, 3
UNION ALL SELECT model, target, nu, 0, round(avg(e), 9) FROM c GROUP BY 1, 2, 3""")
def d18(spark, d):
    rows = auc.case_burden(Tables(spark, d).scored, ["model", "target"])
    return rows.select("model", "target", "uid", F.col("y").cast("int").alias("y"), r9("burden").alias("burden"))


@query("d19_auc_delta", BASE + "," + auc_sql("model, target", "scored") + """
SELECT target, round(max(auc) FILTER (model = 'm1'), 9) AS auc_new, round(max(auc) FILTER (model = 'm2'), 9) AS auc_old,
  round(max(auc) FILTER (model = 'm1') - max(auc) FILTER (model = 'm2'), 9) AS delta FROM aucs GROUP BY 1""")
def d19(spark, d):
    out = auc.auc_delta(Tables(spark, d).scored, "m1", "m2")
    return out.select("target", *[r9(c).alias(c) for c in ("auc_new", "auc_old", "delta")])


@query("d20_pairwise_pearson", BASE + """
SELECT a.target, a.source AS source_a, b.source AS source_b, count(*) AS n,
  CASE WHEN stddev_pop(a.p) * stddev_pop(b.p) > 0 THEN round(covar_pop(a.p, b.p) / (stddev_pop(a.p) * stddev_pop(b.p)), 3) END AS r
FROM sources a JOIN sources b ON a.uid = b.uid AND a.target = b.target AND a.source < b.source WHERE a.p IS NOT NULL AND b.p IS NOT NULL GROUP BY 1, 2, 3""")
def d20(spark, d):
    return agreement.pairwise_pearson(Tables(spark, d).sources)


@query("d21_spearman", BASE + """
, bo AS (SELECT a.model, a.target, a.p, b.p AS q FROM preds a JOIN preds b ON a.uid = b.uid AND a.target = b.target AND b.model = 'm1'),
r AS (SELECT *, rank() OVER (PARTITION BY model, target ORDER BY p) + (count(*) OVER (PARTITION BY model, target, p) - 1) / 2.0 AS ra,
  rank() OVER (PARTITION BY model, target ORDER BY q) + (count(*) OVER (PARTITION BY model, target, q) - 1) / 2.0 AS rb FROM bo)
SELECT model, target, round(corr(ra::DOUBLE, rb::DOUBLE), 9) AS rho FROM r GROUP BY 1, 2""")
def d21(spark, d):
    return agreement.spearman_with(Tables(spark, d).preds, "m1").withColumn("rho", r9("rho"))


@query("d22_source_vs_gold", BASE + ", sg AS (SELECT s.source, target, uid, s.p, g.y FROM sources s JOIN gold g USING (uid, target) WHERE s.p IS NOT NULL AND g.y IS NOT NULL)," + auc_sql("source, target", "sg") + """
SELECT source, target, n, (SELECT count(*) FROM gold g WHERE g.target = aucs.target AND g.y IS NOT NULL) - n AS missing, round(auc, 4) AS auc FROM aucs""")
def d22(spark, d):
    t = Tables(spark, d)
    return agreement.source_vs_gold(t.sources, t.gold.where("y IS NOT NULL"))


def policy_case() -> str:
    out = []
    for name, table in labels.POLICIES.items():
        whens = " ".join(f"WHEN '{s}' THEN {v}::DOUBLE" for s, v in table.items())
        out.append(f"SELECT uid, target, '{name}' AS policy, CASE state {whens} END AS p FROM states")
    return " UNION ALL ".join(out)


@query("d23_policy_auc", BASE + f", pol AS (SELECT q.*, y FROM ({policy_case()}) q JOIN gold USING (uid, target) WHERE q.p IS NOT NULL AND y IN (0, 1))," + auc_sql("policy, target", "pol") + """
SELECT policy, target, n AS n_scored, round(auc, 4) AS auc FROM aucs""")
def d23(spark, d):
    t = Tables(spark, d)
    return agreement.policy_vs_gold(t.states, t.gold, labels.POLICIES)


@query("d24_state_positive_rate", BASE + """
SELECT target, coalesce(state, 'missing') AS state, count(*) AS n, round(avg(y), 2) AS rate FROM states JOIN gold USING (uid, target) WHERE y IS NOT NULL GROUP BY 1, 2""")
def d24(spark, d):
    t = Tables(spark, d)
    return agreement.state_positive_rate(t.states, t.gold.where("y IS NOT NULL"))


WEAK_ST = "ws AS (SELECT * FROM states WHERE uid NOT IN (SELECT uid FROM gold)), so AS (SELECT * FROM sources WHERE p IS NOT NULL)"


def _weak(t):
    ids = t.gold.select("uid").distinct()
    return t.states.join(ids, "uid", "left_anti"), t.sources.where("p IS NOT NULL")


@query("d25_state_score_profile", BASE + f", {WEAK_ST} " + """
SELECT source, target, coalesce(state, 'missing') AS state, count(*) AS n, round(avg(p), 3) AS mean,
  round(avg((p >= 0.8)::INT), 3) AS frac_high, round(avg((p <= 0.2)::INT), 3) AS frac_low FROM ws JOIN so USING (uid, target) GROUP BY 1, 2, 3""")
def d25(spark, d):
    return agreement.state_score_profile(*_weak(Tables(spark, d)))


@query("d25_explicit_state_auc", BASE + f", {WEAK_ST}, ex AS (SELECT so.source, target, p, CASE state WHEN 'criterion_positive' THEN 1 ELSE 0 END AS y FROM ws JOIN so USING (uid, target) WHERE state IN ('criterion_positive', 'explicit_negative'))," + auc_sql("source, target", "ex") + """
SELECT source, target, n, round(auc, 4) AS auc FROM aucs""")
def d25_auc(spark, d):
    return agreement.explicit_state_auc(*_weak(Tables(spark, d)))


DIS = """dis AS (SELECT target, CASE WHEN state = 'criterion_positive' AND p <= 0.2 THEN 'ours_positive_public_low'
  WHEN state = 'explicit_negative' AND p >= 0.8 THEN 'ours_negative_public_high' END AS kind, uid FROM ws JOIN so USING (uid, target) WHERE source = 's1')"""


@query("d26_disagreement_ids", BASE + f", {WEAK_ST}, {DIS} SELECT * FROM dis WHERE kind IS NOT NULL")
def d26(spark, d):
    states, src = _weak(Tables(spark, d))
    return agreement.disagreements(states, src.where("source = 's1'"))


@query("d26_disagreement_counts", BASE + f", {WEAK_ST}, {DIS} SELECT target, kind, count(*) AS n FROM dis WHERE kind IS NOT NULL GROUP BY 1, 2")
def d26_counts(spark, d):
    states, src = _weak(Tables(spark, d))
    return agreement.disagreement_counts(agreement.disagreements(states, src.where("source = 's1'")))


@query("d27_equal_source_mean", BASE + """
, common AS (SELECT uid FROM (SELECT DISTINCT source, uid FROM sources) GROUP BY 1 HAVING count(*) = 3)
SELECT uid, target, CASE WHEN avg(p) BETWEEN 0 AND 1 THEN round(avg(p), 6) END AS p FROM sources
WHERE uid IN (SELECT uid FROM common) AND uid IN (SELECT uid FROM folds WHERE NOT is_gold) GROUP BY 1, 2""")
def d27(spark, d):
    t = Tables(spark, d)
    return softlabels.equal_source_mean(t.sources, t.folds)


AVAIL = """av AS (SELECT u.uid, tgt.target, round(greatest(0.01::DOUBLE, least(0.99::DOUBLE, (SELECT avg(s.p) FROM sources s WHERE s.uid = u.uid AND s.target = tgt.target))), 6) AS p0,
  (SELECT avg(s.p) FROM sources s WHERE s.uid = u.uid AND s.target = tgt.target) AS m
  FROM (SELECT DISTINCT uid FROM sources WHERE uid NOT IN (SELECT uid FROM folds WHERE is_gold)) u, tgt),
avm AS (SELECT uid, target, CASE WHEN m IS NOT NULL THEN p0 END AS p FROM av)"""


@query("d28_available_source_mean", BASE + f", {AVAIL} SELECT uid, target, p FROM avm")
def d28(spark, d):
    t = Tables(spark, d)
    return softlabels.available_source_mean(t.sources, t.folds.where("is_gold"), TARGETS)


@query("d28_masked_cells", BASE + f", {AVAIL} SELECT count(DISTINCT uid) AS n_rows, count(*) FILTER (p IS NULL) AS masked_cells FROM avm")
def d28_masked(spark, d):
    t = Tables(spark, d)
    return softlabels.masked_cells(softlabels.available_source_mean(t.sources, t.folds.where("is_gold"), TARGETS))


@query("d29_calibration", BASE + """
, c AS (SELECT model, target, count(y) AS n, avg(y) AS prev, avg(p) AS pm, stddev_pop(p) AS sd FROM scored WHERE split = 'gold' GROUP BY 1, 2)
SELECT model, target, CASE WHEN n >= 8 THEN 'ok' ELSE 'insufficient_gold' END AS status, n, round(prev, 9) AS gold_prevalence, round(pm, 9) AS pred_mean,
  round(n / (n + 8.0::DOUBLE) * pm + (1 - n / (n + 8.0::DOUBLE)) * prev, 9) AS shrunk_mean, round(sd, 9) AS spread, sd < 1e-4 AS collapsed FROM c""")
def d29(spark, d):
    out = calibration.calibrate_from_gold(Tables(spark, d).scored.where("split = 'gold'"), ["model", "target"])
    return out.select("model", "target", "status", "n", *[r9(c).alias(c) for c in ("gold_prevalence", "pred_mean", "shrunk_mean", "spread")], "collapsed")


@query("d30_masked_bce", BASE + """
, x AS (SELECT p.model, c.target, coalesce(c.y, 0) AS t, c.mask * c.weight AS w, 1 / (1 + exp(-((p.p - 0.5) * 8))) AS q FROM cells c JOIN preds p USING (uid, target))
SELECT model, target, round(coalesce(sum(-(t * ln(q + 1e-8) + (1 - t) * ln(1 - q + 1e-8)) * w) / nullif(sum(w), 0), 0), 9) AS loss, round(sum(w), 6) AS weight, 0::BIGINT AS sentinel_errors FROM x GROUP BY 1, 2""")
def d30(spark, d):
    t = Tables(spark, d)
    rows = t.cells.join(t.preds, ["uid", "target"]).withColumn("logit", (F.col("p") - 0.5) * 8)
    return calibration.masked_bce(rows, ["model", "target"]).select("model", "target", r9("loss").alias("loss"), F.round("weight", 6).alias("weight"), "sentinel_errors")


@query("d31_masked_mean", f"""
WITH v AS (SELECT label, vec_id, embedding, ({sql_h("'mask:' || vec_id")} % 3 > 0)::INT AS m FROM embeddings),
f AS (SELECT label, m, generate_subscripts(embedding, 1) - 1 AS d, unnest(embedding)::DOUBLE AS x FROM v)
SELECT label, d::INT AS dim, round(sum(x * m) / greatest(sum(m), 1e-6), 9) AS x FROM f GROUP BY 1, 2""")
def d31(spark, d):
    v = Tables(spark, d).raw("embeddings").withColumn("mask", (h("mask", F.col("vec_id").cast("string")) % 3 > 0).cast("int"))
    pooled = calibration.masked_mean(v, ["label"], "embedding")
    return pooled.select("label", F.posexplode("pooled").alias("dim", "x")).select("label", "dim", r9("x").alias("x"))


JOINT = """pr AS (SELECT uid, max(y) FILTER (target = 'quality') AS y0, max(y) FILTER (target = 'toxic') AS y1,
  max(mask) FILTER (target = 'quality') AS m0, max(mask) FILTER (target = 'toxic') AS m1 FROM cells GROUP BY 1),
ob AS (SELECT * FROM pr WHERE m0 > 0 OR m1 > 0), cnt AS (SELECT y0, y1, count(*) AS c FROM ob WHERE m0 > 0 AND m1 > 0 GROUP BY 1, 2)"""


def joint_rows(t):
    def pick(c, target):
        return F.max(F.when(F.col("target") == target, F.col(c)))

    rows = t.cells.groupBy("uid").agg(pick("y", "quality").alias("y0"), pick("y", "toxic").alias("y1"),
                                      pick("mask", "quality").alias("m0"), pick("mask", "toxic").alias("m1"))
    return rows.where("m0 > 0 OR m1 > 0")


@query("d32_joint_counts", BASE + f", {JOINT} " + """SELECT coalesce(max(c) FILTER (y0 = 0 AND y1 = 0), 0) AS n00, coalesce(max(c) FILTER (y0 = 0 AND y1 = 1), 0) AS n01,
  coalesce(max(c) FILTER (y0 = 1 AND y1 = 0), 0) AS n10, coalesce(max(c) FILTER (y0 = 1 AND y1 = 1), 0) AS n11 FROM cnt""")
def d32_counts(spark, d):
    return calibration.joint_counts(joint_rows(Tables(spark, d)))


@query("d32_conditional_weights", BASE + f", {JOINT} " + """
, raw AS (SELECT ob.uid, CASE WHEN m0 > 0 AND m1 > 0 THEN 1 / sqrt(c) END AS w FROM ob LEFT JOIN cnt ON ob.y0 = cnt.y0 AND ob.y1 = cnt.y1)
SELECT uid, round(CASE WHEN w IS NULL THEN 1.0::DOUBLE ELSE least(w / (SELECT avg(w) FROM raw), 1.5) END, 9) AS weight FROM raw""")
def d32(spark, d):
    return calibration.conditional_weights(joint_rows(Tables(spark, d)), 1.5).select("uid", r9("weight").alias("weight"))


@query("d33_holdout_report", BASE + """
SELECT fold, count(*) FILTER (NOT is_gold AND NOT hit) AS trainable, count(*) FILTER (is_gold) AS gold, count(*) FILTER (NOT is_gold AND hit) AS dropped_group_member
FROM (SELECT *, group_id IN (SELECT group_id FROM folds WHERE is_gold) AS hit FROM folds) GROUP BY 1""")
def d33(spark, d):
    return folds.holdout_report(folds.all_gold_holdout(Tables(spark, d).folds))


@query("d33_group_sizes", BASE + """
SELECT count(*) FILTER (n > 1) AS duplicate_groups, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_in_duplicate_groups, count(*) FILTER (n > 1 AND g) AS gold_groups_with_other_members
FROM (SELECT group_id, count(*) AS n, bool_or(is_gold) AS g FROM folds GROUP BY 1)""")
def d33_sizes(spark, d):
    return folds.group_size_report(folds.all_gold_holdout(Tables(spark, d).folds))


# raw extraction rows: four replies per hundred repeat an earlier id, some are quarantined, some quote text that is not there
RAW_SQL = f"""raw AS (
  SELECT doc_id AS seq, CASE WHEN {sql_h("'rep:' || doc_id")} % 25 = 0 AND doc_id > 0 THEN 'd' || (doc_id - 1) ELSE uid END AS uid,
    CASE WHEN {sql_h("'q:' || doc_id")} % 30 = 0 THEN 'quarantine' ELSE 'ok' END AS status, {sql_h("'bad:' || doc_id")} % 9 = 0 AS bad FROM train),
al AS (SELECT uid FROM trainable WHERE NOT is_gold),
tagged AS (SELECT r.*, CASE WHEN status <> 'ok' THEN 'quarantined'
    WHEN uid NOT IN (SELECT uid FROM al) OR seq <> min(CASE WHEN status = 'ok' THEN seq END) OVER (PARTITION BY uid) THEN 'selection_or_duplicate_error'
    WHEN bad THEN 'strict_evidence_or_schema_error' ELSE 'valid' END AS reason FROM raw r)"""


def raw_extractions(t):
    num = F.col("doc_id").cast("string")
    uid = F.when((h("rep", num) % 25 == 0) & (F.col("doc_id") > 0), F.concat(F.lit("d"), (F.col("doc_id") - 1).cast("string"))).otherwise(F.col("uid"))
    finding = F.struct(
        F.when(F.col("bad"), F.lit("criterion_positive")).otherwise(F.lit("not_mentioned")).alias("state"),
        F.when(F.col("bad"), F.lit("☃ never in a report")).otherwise(F.lit("")).alias("evidence_span"), F.lit("x").alias("criterion_mapping"))
    return t.train.select(
        F.col("doc_id").alias("seq"), uid.alias("uid"), F.when(h("q", num) % 30 == 0, F.lit("quarantine")).otherwise(F.lit("ok")).alias("status"),
        (h("bad", num) % 9 == 0).alias("bad")).withColumn("targets", F.create_map(*[x for n in TARGETS for x in (F.lit(n), finding)]))


def _quality(t):
    from tallyfold.operators.folds import trainable
    return extraction.label_quality(raw_extractions(t), trainable(t.folds).where("NOT is_gold"), t.train, TARGETS)


@query("d34_label_quality", BASE + f", {RAW_SQL} " + """
, a AS (SELECT count(*) AS attempted, count(*) FILTER (reason = 'valid') AS valid, count(*) FILTER (reason = 'quarantined') AS quarantined,
  count(*) FILTER (reason = 'selection_or_duplicate_error') AS selection_errors, count(*) FILTER (reason = 'strict_evidence_or_schema_error') AS evidence_errors FROM tagged)
SELECT attempted, valid, quarantined, selection_errors, evidence_errors, round((attempted - valid)::DOUBLE / attempted, 9) AS error_rate,
  valid >= 50 AND (attempted - valid)::DOUBLE / attempted <= 0.05 AND selection_errors = 0 AS passed FROM a""")
def d34(spark, d):
    return extraction.quality_report(_quality(Tables(spark, d)), 50).withColumn("error_rate", r9("error_rate"))


@query("d34_label_quality_states", BASE + f", {RAW_SQL} SELECT target, 'not_mentioned' AS state, count(*) AS n FROM tagged, tgt WHERE reason = 'valid' GROUP BY 1")
def d34_states(spark, d):
    return extraction.state_counts(_quality(Tables(spark, d)))


# manifest rows: one study per order, one slot per line-number class
DETAIL_SQL = f"""det AS (SELECT 's' || o_orderkey AS uid, slot, {sql_h("'pres:' || o_orderkey || ':' || slot")} % 10 > 0 AS present, {sql_h("'fall:' || o_orderkey || ':' || slot")} % 4 = 0 AS fallback,
  ({sql_h("'n:' || o_orderkey || ':' || slot")} % 40 + 3)::INT AS n_slices, ({sql_h("'n:' || o_orderkey || ':' || slot")} % 40 % 13)::INT AS duplicate_centers,
  ({sql_h("'sp:' || o_orderkey || ':' || slot")} % 500)::DOUBLE / 100 AS spacing, {sql_h("'err:' || o_orderkey || ':' || slot")} % 3 AS e FROM orders, (SELECT unnest(range(5))::INT AS slot)),
dt AS (SELECT uid, slot, present, fallback, CASE WHEN present THEN n_slices END AS n_slices, CASE WHEN present THEN duplicate_centers END AS duplicate_centers,
  CASE WHEN present AND e > 0 THEN spacing END AS spacing, CASE WHEN NOT present THEN CASE e WHEN 0 THEN 'missing_plane_metadata' WHEN 1 THEN 'no_dicom_files' END END AS error,
  CASE WHEN present THEN CASE e WHEN 0 THEN 'instance_number_fallback' ELSE 'iop_ipp' END END AS "order" FROM det)"""


def manifest_rows(t):
    """One row per order with five nested slots; each hash is taken once per (order, slot)."""
    key, slot = F.col("o_orderkey").cast("string"), F.col("slot").cast("string")
    rows = t.raw("orders").select("o_orderkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("slot"))
    rows = rows.select("o_orderkey", "slot", *[h(tag, key, slot).alias(tag) for tag in ("pres", "fall", "n", "sp", "err")])
    present, e = F.col("pres") % 10 > 0, F.col("err") % 3
    n = (F.col("n") % 40 + 3).cast("int")
    detail = F.struct(
        "slot", present.alias("present"), (F.col("fall") % 4 == 0).alias("fallback"), F.when(present, n).alias("n_slices"),
        F.when(present, n).alias("n_decoded_slices"), F.when(present, (F.col("n") % 40 % 13).cast("int")).alias("duplicate_centers"),
        F.when(present & (e > 0), (F.col("sp") % 500).cast("double") / 100).alias("slice_spacing_mm_median"),
        F.when(~present, F.when(e == 0, "missing_plane_metadata").when(e == 1, "no_dicom_files")).alias("error"),
        F.when(present, F.when(e == 0, "instance_number_fallback").otherwise("iop_ipp")).alias("order"))
    per = rows.groupBy("o_orderkey").agg(F.sort_array(F.collect_list(detail)).alias("d"))  # five slots
    return per.select(F.concat(F.lit("s"), key).alias("uid"), F.transform("d", lambda x: x.dropFields("slot")).alias("series_details"),
                      F.transform("d", lambda x: x["present"].cast("double")).alias("slot_mask"))


@query("d35_slot_coverage", BASE + f", {DETAIL_SQL} " + """
SELECT slot, count(*) FILTER (present) AS present, count(*) FILTER (NOT present) AS missing, count(*) FILTER (present AND fallback) AS fallback,
  sum(n_slices)::BIGINT AS decoded_slices, sum(n_slices)::BIGINT AS available_slices, sum(duplicate_centers)::BIGINT AS duplicate_centers, round(median(spacing), 9) AS slice_spacing_mm_median FROM dt GROUP BY 1""")
def d35(spark, d):
    out = manifest.slot_coverage(manifest.slot_details(manifest_rows(Tables(spark, d))))
    return out.withColumn("slice_spacing_mm_median", r9("slice_spacing_mm_median"))


@query("d35_missing_reasons", BASE + f", {DETAIL_SQL} SELECT slot, coalesce(error, 'unknown') AS reason, count(*) AS n FROM dt WHERE NOT present GROUP BY 1, 2")
def d35_missing(spark, d):
    return manifest.missing_reasons(manifest.slot_details(manifest_rows(Tables(spark, d))))


@query("d35_order_modes", BASE + f', {DETAIL_SQL} SELECT "order", count(*) AS n FROM dt WHERE "order" IS NOT NULL GROUP BY 1')
def d35_modes(spark, d):
    return manifest.order_modes(manifest.slot_details(manifest_rows(Tables(spark, d))))


@query("d35_present_planes", BASE + f", {DETAIL_SQL} SELECT present, count(*) AS n FROM (SELECT uid, count(*) FILTER (present)::INT AS present FROM dt GROUP BY 1) GROUP BY 1")
def d35_planes(spark, d):
    return manifest.present_planes(manifest_rows(Tables(spark, d)))


@query("d36_size_profile", """SELECT source, round(avg(n), 9) AS mean, max(n) AS max, round(quantile_cont(n::DOUBLE, 0.5), 9) AS p50, round(quantile_cont(n::DOUBLE, 0.95), 9) AS p95
FROM (SELECT source, n_chars AS n FROM documents) GROUP BY 1""")
def d36(spark, d):
    out = manifest.size_profile(Tables(spark, d).raw("documents"), "n_chars", ["source"])
    return out.select("source", r9("mean").alias("mean"), "max", r9("p50").alias("p50"), r9("p95").alias("p95"))


@query("d37_full_projection", """
WITH m AS (SELECT lang AS config, count(*) AS n_built, avg(n_chars) AS b, avg(n_chars / 1000.0::DOUBLE) AS s FROM documents GROUP BY 1)
SELECT config, n_built, round(b, 6) AS bytes_per_study, round(s, 3) AS seconds_per_study, round(100000 / b, 3) AS compression_ratio,
  round(b * 4407 / 1024.0::DOUBLE ** 3, 2) AS projected_gib, round(s * 4407 / 3600, 2) AS projected_hours FROM m""")
def d37(spark, d):
    rows = Tables(spark, d).raw("documents").select(
        F.col("lang").alias("config"), F.col("n_chars").cast("double").alias("bytes"), (F.col("n_chars") / 1000.0).alias("seconds"))
    return manifest.project_full(rows, 4407, 100000).withColumn("bytes_per_study", F.round("bytes_per_study", 6))


@query("d38_runtime_gate", """
WITH m AS (SELECT source AS key, avg(n_chars) / 100 AS s, count(*) AS n FROM documents GROUP BY 1)
SELECT key, round(s, 9) AS seconds_per_study, n AS n_measured, CASE WHEN n >= 30 THEN round(s * 1300, 6) END AS projected_seconds,
  coalesce(n >= 30 AND s * 1300 < 32400, false) AS under_limit, CASE WHEN n < 30 THEN 'benchmark_too_small' ELSE 'measured_batch' END AS reason FROM m""")
def d38(spark, d):
    m = Tables(spark, d).raw("documents").groupBy(F.col("source").alias("key")).agg(
        (F.avg("n_chars") / 100).alias("seconds_per_study"), F.count(F.lit(1)).alias("n_measured"))
    return manifest.runtime_gate(m).withColumn("seconds_per_study", r9("seconds_per_study")).withColumn("projected_seconds", F.round("projected_seconds", 6))


@query("d38_training_budget", """
WITH m AS (SELECT c_nationkey AS key, count(*)::DOUBLE AS studies, sum(abs(c_acctbal)) AS seconds, 5000.0::DOUBLE AS total, max(c_acctbal) AS peak FROM customer GROUP BY 1),
x AS (SELECT key, studies / seconds AS rate, total / (studies / seconds) AS proj, peak / 10000 AS frac FROM m)
SELECT key, round(rate, 12) AS studies_per_second, round(proj, 3) AS projected_seconds, round(frac, 9) AS peak_fraction,
  concat_ws(',', CASE WHEN proj > 25000000 THEN 'projected_training_time_exceeded' END, CASE WHEN frac > 0.99 THEN 'peak_vram_fraction_exceeded' END) AS reasons,
  NOT (proj > 25000000 OR frac > 0.99) AS passed FROM x""")
def d38_budget(spark, d):
    m = Tables(spark, d).raw("customer").groupBy(F.col("c_nationkey").alias("key")).agg(
        F.count(F.lit(1)).cast("double").alias("studies"), F.sum(F.abs("c_acctbal")).alias("seconds"), F.lit(5000.0).alias("total_studies"),
        F.max("c_acctbal").alias("peak_bytes"), F.lit(10000.0).alias("device_bytes"))
    out = manifest.training_budget(m, 25_000_000, 0.99)
    return out.select("key", F.round("studies_per_second", 12).alias("studies_per_second"), F.round("projected_seconds", 3).alias("projected_seconds"),
                      r9("peak_fraction").alias("peak_fraction"), F.array_join("reasons", ",").alias("reasons"), "passed")


@query("d39_prediction_parity", BASE + f"""
, q AS (SELECT model, uid, target, p, p + CASE WHEN {sql_h("'par:' || model || ':' || uid")} % 50 = 0 THEN 0.015::DOUBLE ELSE 0.0001::DOUBLE END AS p2 FROM preds)
SELECT model, round(max(abs(p - p2)), 9) AS max_abs, round(avg(abs(p - p2)), 9) AS mean_abs, max(abs(p - p2)) <= 0.02 AND avg(abs(p - p2)) <= 0.002 AS ok FROM q GROUP BY 1""")
def d39(spark, d):
    a = Tables(spark, d).preds.select("model", "uid", "target", "p")
    b = a.withColumn("p", F.col("p") + F.when(h("par", F.col("model"), F.col("uid")) % 50 == 0, 0.015).otherwise(0.0001))
    out = agreement.parity(a, b)
    return out.select("model", r9("max_abs").alias("max_abs"), r9("mean_abs").alias("mean_abs"), "ok")


POOLED = """pooled AS (SELECT s.uid, s.target, s.y, s.p, CASE WHEN s.model IN ('m1', 'm3') THEN 'new' ELSE 'old' END AS model FROM scored s JOIN folds f USING (uid)
  WHERE s.split = 'weak' AND ((f.fold = 0 AND s.model IN ('m1', 'm2')) OR (f.fold = 1 AND s.model IN ('m3', 'm4'))))"""


@query("d40_pooled_two_fold_delta", BASE + f", {POOLED}," + exact_sql("pooled", 2000) + ", rows AS (SELECT b, model, target, y, p, w FROM pooled JOIN w USING (uid))," + auc_sql("b, model, target", "rows", "w") + """
, dl AS (SELECT b, avg(auc) FILTER (model = 'new') - avg(auc) FILTER (model = 'old') AS delta FROM aucs GROUP BY 1)
SELECT round(quantile_cont(delta, 0.025), 9) AS ci_low, round(quantile_cont(delta, 0.975), 9) AS ci_high, count(delta) AS n_boot, (SELECT count(DISTINCT uid) FROM pooled) AS n_paired FROM dl""")
def d40(spark, d):
    t = Tables(spark, d)
    f = t.folds.select("uid", "fold")
    rows = t.preds.join(f, "uid").where("(fold = 0 AND model IN ('m1', 'm2')) OR (fold = 1 AND model IN ('m3', 'm4'))").drop("fold")
    out = review.second_fold_review(rows, t.cells, {"0": ("m1", "m2"), "1": ("m3", "m4")}, 2000, SEED)["delta"]
    return out.select(r9("ci_low").alias("ci_low"), r9("ci_high").alias("ci_high"), "n_boot", "n_paired")


@query("d40_pooled_two_fold_delta_poisson", BASE + f", {POOLED}," + poisson_sql("pooled", 2000, ["uid"]) + ", rows AS (SELECT b, model, target, y, p, w FROM pooled JOIN w USING (uid))," + auc_sql("b, model, target", "rows", "w") + """
, dl AS (SELECT b, avg(auc) FILTER (model = 'new') - avg(auc) FILTER (model = 'old') AS delta FROM aucs GROUP BY 1)
SELECT round(quantile_cont(delta, 0.025), 9) AS ci_low, round(quantile_cont(delta, 0.975), 9) AS ci_high, count(delta) AS n_boot, (SELECT count(DISTINCT uid) FROM pooled) AS n_paired FROM dl""")
def d40_poisson(spark, d):
    t = Tables(spark, d)
    f = t.folds.select("uid", "fold")
    rows = t.preds.join(f, "uid").where("(fold = 0 AND model IN ('m1', 'm2')) OR (fold = 1 AND model IN ('m3', 'm4'))").drop("fold")
    out = review.second_fold_review(rows, t.cells, {"0": ("m1", "m2"), "1": ("m3", "m4")}, 2000, SEED, method="poisson")["delta"]
    return out.select(r9("ci_low").alias("ci_low"), r9("ci_high").alias("ci_high"), "n_boot", "n_paired")


@query("d41_failure_breaker", """
WITH x AS (SELECT user_id AS run, event_id, event_type = 'error' AS rej FROM events),
r AS (SELECT run, event_id, count(*) OVER w AS a, sum(rej::INT) OVER w AS b FROM x WINDOW w AS (PARTITION BY run ORDER BY event_id))
SELECT run, min(event_id) AS stopped_at, arg_min(a, event_id) AS attempted, arg_min(b, event_id)::BIGINT AS rejected FROM r WHERE a >= 10 AND b::DOUBLE / a > 0.2 GROUP BY 1""")
def d41(spark, d):
    rows = Tables(spark, d).raw("events").select(F.col("user_id").alias("run"), "event_id", (F.col("event_type") == "error").alias("rej"))
    return extraction.failure_breaker(rows, ["run"], "event_id", "rej")


@query("d42_progress_report", """
WITH x AS (SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS done, 500 AS total, epoch(ts) - epoch(TIMESTAMP '2024-01-01') AS el FROM events),
l AS (SELECT run, max(done) AS done, max(total) AS total, arg_max(el, done) AS el FROM x GROUP BY 1)
SELECT run, done, total, round(el, 3) AS elapsed_seconds, round(done / el * 60, 2) AS per_minute, round((total - done) / (done / el), 1) AS eta_seconds FROM l""")
def d42(spark, d):
    from tallyfold.scale import ordinal_rank
    e = Tables(spark, d).raw("events")
    rows = ordinal_rank(e.select(F.col("user_id").alias("run"), "event_id", "ts"), ["run"], [F.col("event_id")], "done")
    el = F.col("ts").cast("timestamp").cast("double") - F.lit("2024-01-01").cast("timestamp").cast("double")
    out = manifest.progress_report(rows.select("run", "done", F.lit(500).alias("total"), el.alias("elapsed_seconds")), ["run"])
    return out.withColumn("elapsed_seconds", F.round("elapsed_seconds", 3))


@query("d43_soft_coverage", BASE + """
SELECT count(*) AS n FROM trainable WHERE fold <> 0 AND uid IN (SELECT uid FROM sources WHERE source = 's1' AND p IS NOT NULL)""")
def d43(spark, d):
    t = Tables(spark, d)
    return folds.soft_training_pool(t.folds, t.sources.where("source = 's1'"), "0").agg(F.count(F.lit(1)).alias("n"))


