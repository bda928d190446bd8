"""Predicates, cell rules and cohorts."""

from pyspark.sql import functions as F

from catalog import query
from catalog.base import BASE, TARGETS, Tables, h, sql_h, sql_nonempty
from catalog.scans import ENV_SQL, envelopes
from tallyfold.functions import predicates as P
from tallyfold.operators import contracts, labels, selection, softlabels
from tallyfold.operators.reshape import to_long, to_wide


@query("b1_nonempty", BASE + f"SELECT uid, {sql_nonempty('quality')} AS q, {sql_nonempty('toxic')} AS t FROM train")
def b1(spark, d):
    return Tables(spark, d).train.select("uid", P.nonempty(F.col("quality")).alias("q"), P.nonempty(F.col("toxic")).alias("t"))


@query("b2_gold_flag", BASE + "SELECT uid, is_gold FROM folds")
def b2(spark, d):
    return Tables(spark, d).train.select("uid", P.all_nonempty(TARGETS).alias("is_gold"))


@query("b3_wide_to_long", BASE + "SELECT model, uid, target, p FROM preds")
def b3(spark, d):
    wide = to_wide(Tables(spark, d).preds, ["model", "uid"], TARGETS)
    return to_long(wide, ["model", "uid"], TARGETS)


@query("b3_long_to_wide", BASE + "SELECT model, uid, max(p) FILTER (target = 'quality') AS quality, max(p) FILTER (target = 'toxic') AS toxic FROM preds GROUP BY 1, 2")
def b3_wide(spark, d):
    return to_wide(Tables(spark, d).preds, ["model", "uid"], TARGETS)


@query("b4_safe_id", r"""
SELECT url AS id, regexp_full_match(url, '[\p{L}\p{N}._-]{1,240}') AS safe FROM pages UNION ALL
SELECT o_orderpriority || o_orderkey, regexp_full_match(o_orderpriority || o_orderkey, '[\p{L}\p{N}._-]{1,240}') FROM orders""")
def b4(spark, d):
    t = Tables(spark, d)
    ids = t.raw("pages").select(F.col("url").alias("id")).unionByName(
        t.raw("orders").select(F.concat("o_orderpriority", F.col("o_orderkey").cast("string")).alias("id")))
    return ids.select("id", P.safe_id(F.col("id")).alias("safe"))


@query("b5_synthetic_id", f"""
SELECT 'synthetic_uid' AS "check", uid AS key FROM (SELECT CASE WHEN {sql_h("'syn:' || doc_id")} % 10 = 0 THEN 'syn-' WHEN {sql_h("'syn:' || doc_id")} % 10 = 1 THEN 'synthetic-' ELSE 'd' END || doc_id AS uid FROM documents)
WHERE uid LIKE 'syn-%' OR uid LIKE 'synthetic-%'""")
def b5(spark, d):
    n = F.col("doc_id").cast("string")
    k = h("syn", n) % 10
    ids = Tables(spark, d).raw("documents").select(F.concat(F.when(k == 0, "syn-").when(k == 1, "synthetic-").otherwise("d"), n).alias("uid"))
    return contracts.synthetic_ids(ids)


ODD_SQL = f"""odd AS (SELECT 'd' || doc_id AS uid, CASE {sql_h("'odd:' || doc_id")} % 8 WHEN 0 THEN NULL WHEN 1 THEN -1.0::DOUBLE WHEN 2 THEN -2.0::DOUBLE WHEN 3 THEN 'NaN'::DOUBLE
  WHEN 4 THEN 'Infinity'::DOUBLE WHEN 5 THEN 1.01::DOUBLE ELSE (n_chars % 101)::DOUBLE / 100 END AS v FROM documents)"""


def odd_values(t):
    k = h("odd", F.col("doc_id").cast("string")) % 8
    v = (F.when(k == 0, F.lit(None).cast("double")).when(k == 1, F.lit(-1.0)).when(k == 2, F.lit(-2.0)).when(k == 3, F.lit(float("nan")))
         .when(k == 4, F.lit(float("inf"))).when(k == 5, F.lit(1.01)).otherwise((F.col("n_chars") % 101).cast("double") / 100))
    return t.raw("documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("uid"), v.alias("v"))


@query("b6_probability", f"WITH {ODD_SQL} SELECT uid, coalesce(v BETWEEN 0 AND 1 AND NOT isnan(v), false) AS ok FROM odd")
def b6(spark, d):
    return odd_values(Tables(spark, d)).select("uid", P.is_probability(F.col("v")).alias("ok"))


@query("b7_soft_target", f"""WITH {ODD_SQL} SELECT uid, CASE WHEN v BETWEEN 0 AND 1 THEN v END AS p, v IS NOT NULL AND v <> -1 AND NOT (v BETWEEN 0 AND 1) AS error FROM odd""")
def b7(spark, d):
    return odd_values(Tables(spark, d)).select("uid", P.soft_target(F.col("v")).alias("p"), P.soft_target_error(F.col("v")).alias("error"))


@query("b8_gold_label", BASE + """
SELECT uid, CASE WHEN trim(toxic) IN ('0', '1') THEN trim(toxic)::DOUBLE END AS y, CASE WHEN trim(toxic) IN ('0', '1') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS mask,
  CASE WHEN trim(toxic) IN ('0', '1') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM train""")
def b8(spark, d):
    return Tables(spark, d).train.select("uid", P.gold_label(F.col("toxic")).alias("l")).select("uid", "l.*")


@query("b9_state_label", BASE + "SELECT uid, target, y, mask, weight FROM weak_cells")
def b9(spark, d):
    return Tables(spark, d).states.select("uid", "target", P.state_label(F.col("state")).alias("l")).select("uid", "target", "l.*")


@query("b10_numeric_label", BASE + f", {ENV_SQL} SELECT uid, target, y, mask, weight FROM envc WHERE k = 4 AND y IS NOT NULL")
def b10(spark, d):
    tagged = labels.tag_envelopes(envelopes(Tables(spark, d))).where("form = 'numeric'")
    return labels.envelope_cells(tagged, TARGETS).drop("source").where("y IS NOT NULL")


@query("b11_policy_scores", BASE + """
, pol AS (SELECT * FROM (VALUES ('current_training', 'criterion_positive', 1.0), ('current_training', 'explicit_negative', 0.0), ('current_training', 'borderline_negative_hint', 0.0),
  ('unmentioned_low', 'criterion_positive', 1.0), ('unmentioned_low', 'explicit_negative', 0.0), ('unmentioned_low', 'borderline_negative_hint', 0.0), ('unmentioned_low', 'uncertain', 0.5), ('unmentioned_low', 'not_mentioned', 0.25),
  ('borderline_positive', 'criterion_positive', 1.0), ('borderline_positive', 'explicit_negative', 0.0), ('borderline_positive', 'borderline_negative_hint', 1.0), ('borderline_positive', 'uncertain', 0.5), ('borderline_positive', 'not_mentioned', 0.25),
  ('borderline_half', 'criterion_positive', 1.0), ('borderline_half', 'explicit_negative', 0.0), ('borderline_half', 'borderline_negative_hint', 0.5), ('borderline_half', 'uncertain', 0.5), ('borderline_half', 'not_mentioned', 0.25)) v(policy, state, score))
SELECT uid, target, state, policy, score::DOUBLE AS p FROM states JOIN pol USING (state)""")
def b11(spark, d):
    return labels.policy_scores(Tables(spark, d).states, labels.POLICIES)


@query("b12_soft_row_violations", f"""
WITH x AS (SELECT doc_id, {sql_h("'sv:' || doc_id")} % 12 AS k FROM documents),
r AS (SELECT CASE WHEN k = 0 THEN '' WHEN k = 1 AND doc_id > 0 THEN 'd' || (doc_id - 1) ELSE 'd' || doc_id END AS uid, k FROM x)
SELECT uid, 'malformed_row' AS "check" FROM r WHERE k = 0 UNION ALL SELECT uid, 'unknown_target' FROM r WHERE k = 2
UNION ALL SELECT uid, 'not_a_probability' FROM r WHERE k IN (3, 5) UNION ALL SELECT uid, 'bad_weight' FROM r WHERE k = 4
UNION ALL SELECT uid, 'duplicate_uid' FROM r GROUP BY uid HAVING count(*) > 1""")
def b12(spark, d):
    k = h("sv", F.col("doc_id").cast("string")) % 12
    n = F.col("doc_id").cast("string")
    uid = F.when(k == 0, F.lit("")).when((k == 1) & (F.col("doc_id") > 0), F.concat(F.lit("d"), (F.col("doc_id") - 1).cast("string"))).otherwise(
        F.concat(F.lit("d"), n))
    p = F.when(k == 3, F.lit(1.5)).when(k == 5, F.lit(-1.0)).otherwise(F.lit(0.25))
    rows = Tables(spark, d).raw("documents").select(
        uid.alias("uid"), F.create_map(F.when(k == 2, "other").otherwise("quality"), p).alias("soft_targets"),
        F.create_map(F.lit("quality"), F.when(k == 4, F.lit(-1.0)).otherwise(F.lit(1.0))).alias("target_weights"))
    return softlabels.soft_rows_violations(rows, TARGETS)


@query("b13_clip_round", BASE + "SELECT uid, target, source, round(greatest(0.05::DOUBLE, least(0.9::DOUBLE, p / 3)), 6) AS p FROM sources WHERE p IS NOT NULL")
def b13(spark, d):
    return Tables(spark, d).sources.where("p IS NOT NULL").select("uid", "target", "source", F.round(P.clip(F.col("p") / 3, 0.05, 0.9), 6).alias("p"))


@query("b14_development_cohort", BASE + f"""
SELECT uid FROM train WHERE uid IN (SELECT uid FROM trainable WHERE NOT is_gold) AND {sql_h("'done:' || uid")} % 4 <> 0 ORDER BY uid LIMIT 100""")
def b14(spark, d):
    t = Tables(spark, d)
    done = t.train.where(h("done", F.col("uid")) % 4 == 0).select("uid")
    return selection.new_attempts(selection.development_cohort(t.train.select("uid"), t.folds), done, 100)


@query("b14_gold_cohort", BASE + "SELECT uid FROM folds WHERE is_gold")
def b14_gold(spark, d):
    t = Tables(spark, d)
    return selection.gold_cohort(t.train.select("uid"), t.folds)


@query("b15_confident_rows", BASE + """
SELECT uid FROM (SELECT uid, max(p) FILTER (target = 'quality') AS a, max(p) FILTER (target = 'toxic') AS b FROM sources WHERE source = 's1' GROUP BY 1)
WHERE a <= 0.1 OR a >= 0.9 OR b <= 0.1 OR b >= 0.9""")
def b15(spark, d):
    wide = to_wide(Tables(spark, d).sources.where("source = 's1'"), ["uid"], TARGETS)
    return wide.where(P.confident([F.col(t) for t in TARGETS])).select("uid")


@query("b16_hash_sample", BASE + "SELECT uid FROM folds ORDER BY is_gold DESC, sha256(uid), uid LIMIT 300")
def b16(spark, d):
    return selection.hash_sample(Tables(spark, d).folds, 300, [F.col("is_gold").desc()]).select("uid")


@query("b17_seeded_sample", BASE + f"SELECT uid FROM train ORDER BY {sql_h(chr(39) + '11:' + chr(39) + ' || uid')}, uid LIMIT 64")
def b17(spark, d):
    return selection.hash_sample(Tables(spark, d).train.select("uid"), 64, seed=11)


@query("b18_id_shards", BASE + "SELECT uid, ((row_number() OVER (ORDER BY uid) - 1) % 5)::INT AS shard FROM train")
def b18(spark, d):
    return selection.id_shards(Tables(spark, d).train, 5)


@query("b19_gold_first", BASE + "SELECT uid, is_gold FROM folds ORDER BY is_gold DESC, uid LIMIT 50")
def b19(spark, d):
    return selection.gold_first(Tables(spark, d).folds).select("uid", "is_gold")


@query("b20_companion_filter", BASE + """
SELECT a.uid, a.y FROM cells a JOIN cells b USING (uid) WHERE a.target = 'toxic' AND b.target = 'quality' AND a.mask > 0 AND b.mask > 0 AND b.y = 1 AND a.y IN (0, 1)""")
def b20(spark, d):
    return selection.where_companion(Tables(spark, d).cells, "toxic", "quality", 1.0).select("uid", "y")


