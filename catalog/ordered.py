"""Ranks, orders, folds, set operations and differences."""

from pyspark.sql import functions as F

from catalog import query
from catalog.base import BASE, SEED, SLOTS, TARGETS, Tables, h, r9, sql_h
from tallyfold.functions import arrays
from tallyfold.functions.hashing import id_list_fingerprint
from tallyfold.operators import auc, configdiff, extraction, folds, manifest, ranks, selection, series
from tallyfold.plans import folds as fold_plans


@query("e1_rank_mean", BASE + """
, r AS (SELECT model, target, uid, (row_number() OVER (PARTITION BY model, target ORDER BY p, uid) - 1)::DOUBLE / (count(*) OVER (PARTITION BY model, target) - 1) AS s FROM preds)
SELECT uid, target, round(avg(s), 9) AS p FROM r GROUP BY 1, 2""")
def e1(spark, d):
    return ranks.rank_mean(Tables(spark, d).preds).withColumn("p", r9("p"))


NR = """nr AS (SELECT model, uid, target, (rank() OVER (PARTITION BY model, target ORDER BY p) + (count(*) OVER (PARTITION BY model, target, p) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY model, target) AS r FROM preds)"""


@query("e2_normalized_ranks", BASE + f", {NR} SELECT model, uid, target, round(r, 9) AS nrank FROM nr")
def e2(spark, d):
    out = ranks.normalized_ranks(Tables(spark, d).preds, ["model", "target"], "p")
    return out.select("model", "uid", "target", r9("nrank").alias("nrank"))


@query("e3_rank_blend", BASE + f", {NR} SELECT a.uid, a.target, round(0.7::DOUBLE * a.r + 0.3::DOUBLE * b.r, 9) AS p FROM nr a JOIN nr b USING (uid, target) WHERE a.model = 'm1' AND b.model = 'm2'")
def e3(spark, d):
    p = Tables(spark, d).preds
    return ranks.rank_blend(p.where("model = 'm1'"), p.where("model = 'm2'"), 0.3).withColumn("p", r9("p"))


@query("e4_equal_mean", BASE + "SELECT uid, target, round(avg(p), 9) AS p, count(*) AS members, count(*) = 4 AS complete FROM preds GROUP BY 1, 2")
def e4(spark, d):
    return ranks.equal_mean(Tables(spark, d).preds).withColumn("p", r9("p"))


@query("e5_route", BASE + "SELECT uid, target, p FROM preds WHERE (target = 'toxic' AND model = 'm1') OR (target <> 'toxic' AND model = 'm2')")
def e5(spark, d):
    p = Tables(spark, d).preds
    return ranks.route(p.where("model = 'm1'"), p.where("model = 'm2'"), ["toxic"])


PART = f"pp AS (SELECT * FROM preds WHERE model = 'm1' AND {sql_h(chr(39) + 'gone:' + chr(39) + ' || uid')} % 12 > 0)"


@query("e6_fill_missing", BASE + f", {PART} " + """
SELECT t.uid, tgt.target, round(coalesce(pp.p, (SELECT avg(q.p) FROM pp q WHERE q.target = tgt.target)), 9) AS p, pp.p IS NULL AS filled FROM train t CROSS JOIN tgt LEFT JOIN pp ON pp.uid = t.uid AND pp.target = tgt.target""")
def e6(spark, d):
    t = Tables(spark, d)
    part = t.preds.where("model = 'm1'").where(h("gone", F.col("uid")) % 12 > 0)
    return ranks.fill_missing(part, t.train, TARGETS).withColumn("p", r9("p"))


@query("e6_missing_share", BASE + f", {PART} SELECT count(*) AS n_required, count(*) FILTER (uid NOT IN (SELECT uid FROM pp)) AS n_missing, count(*) FILTER (uid NOT IN (SELECT uid FROM pp)) <= 0.1 * count(*) AS ok FROM train")
def e6_share(spark, d):
    t = Tables(spark, d)
    return ranks.missing_share(t.preds.where("model = 'm1'").where(h("gone", F.col("uid")) % 12 > 0), t.train)


@query("e7_pct_rank", """
SELECT doc_id, lang, round((rank() OVER (PARTITION BY lang ORDER BY n_chars) + (count(*) OVER (PARTITION BY lang, n_chars) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY lang), 9) AS pct FROM documents""")
def e7(spark, d):
    rows = Tables(spark, d).raw("documents").select("doc_id", "lang", "n_chars")
    return ranks.normalized_ranks(rows, ["lang"], "n_chars", "pct").select("doc_id", "lang", r9("pct").alias("pct"))


def slot_sql() -> str:
    fits = {"fluid": {True: "fluid <> '0'", False: "true"}, "structural": {True: "fluid = '0'", False: "fluid = '0'"}}
    out = []
    for i, (plane, kind) in enumerate(SLOTS):
        both = (plane, "structural") in SLOTS
        want = "fluid = '1'" if kind == "fluid" else "fluid <> '1'"
        out.append(f"""SELECT study, {i} AS slot, arg_min(series, (CASE WHEN n > 0 THEN 0 ELSE 1 END, CASE WHEN {want} THEN 0 ELSE 1 END, CASE WHEN fat = '1' THEN 0 ELSE 1 END, -n, series)) AS series
          FROM series WHERE plane = '{plane}' AND {fits[kind][both]} GROUP BY 1""")
    return " UNION ALL ".join(out)


@query("e8_slot_selection", BASE + f"""
, picked AS ({slot_sql()})
SELECT s.study, g.slot, p.series FROM (SELECT DISTINCT study FROM series) s CROSS JOIN (SELECT unnest(range(5))::INT AS slot) g LEFT JOIN picked p ON p.study = s.study AND p.slot = g.slot""")
def e8(spark, d):
    return series.select_slots(Tables(spark, d).series, SLOTS)


@query("e9_slot_candidates", BASE + """
SELECT study, slot, row_number() OVER (PARTITION BY study, slot ORDER BY n DESC, series) - 1 AS position, series, n FROM (
  SELECT study, (CASE plane WHEN 'Sagittal' THEN 0 WHEN 'Coronal' THEN 1 ELSE 2 END + 3 * (1 - fat::INT))::INT AS slot, series, max(n) AS n FROM series GROUP BY 1, 2, 3)""")
def e9(spark, d):
    s = Tables(spark, d).series.groupBy("study", "series", "plane", "fat").agg(F.max("n").alias("n"))
    return series.slot_candidates(s)


# axis-aligned slices project on z; tilted ones on 0.6 z, which breaks coherence for the whole series
SLICE_SQL = f"""hd AS (SELECT study, series, path, sop, tilt, om, z, CASE WHEN om <> 0 OR {sql_h("'inst:' || substr(study, 2)")} % 2 = 0 THEN instance END AS instance FROM headers),
md AS (SELECT study, series, count(*) AS n, count(instance) AS ni, bool_or(tilt = 0) AND NOT bool_and(tilt = 0) AS mixed, min(om) AS om FROM hd GROUP BY 1, 2),
mo AS (SELECT *, CASE WHEN om <> 0 AND NOT mixed THEN 'iop_ipp' WHEN ni = n THEN 'instance_number_fallback' ELSE 'path_fallback_not_sop_lex' END AS mode FROM md),
od AS (SELECT h.*, m.mode, m.n, CASE WHEN h.om <> 0 THEN CASE WHEN h.tilt = 0 THEN z * 0.6::DOUBLE ELSE z::DOUBLE END END AS proj FROM hd h JOIN mo m USING (study, series)),
ord AS (SELECT *, row_number() OVER (PARTITION BY study, series ORDER BY CASE mode WHEN 'iop_ipp' THEN proj WHEN 'instance_number_fallback' THEN instance::DOUBLE ELSE 0 END, path) - 1 AS position FROM od)"""


def unique_headers(t):
    """The driver table repeats some (order, part, supplier, line) rows; slices need a unique path. One shuffle, by series, serves the
    operators as well."""
    return t.headers.repartition("study", "series").dropDuplicates(["study", "series", "path"])


UNIQ = "headers AS (SELECT DISTINCT ON (study, series, path) * FROM headers0)"
HBASE = BASE.replace("headers AS (", "headers0 AS (") + f", {UNIQ}"


@query("e10_slice_order", HBASE + f", {SLICE_SQL} SELECT study, series, path, mode, round(proj, 6) AS proj, position FROM ord")
def e10(spark, d):
    out = series.order_slices(unique_headers(Tables(spark, d)))
    return out.select("study", "series", "path", "mode", F.round("proj", 6).alias("proj"), "position")


@query("e11_through_plane_geometry", HBASE + f", {SLICE_SQL} " + """
, gp AS (SELECT study, series, position, proj - lag(proj) OVER (PARTITION BY study, series ORDER BY position) AS gap FROM ord),
ag AS (SELECT study, series, median(gap) AS md, max(gap) AS mx FROM gp WHERE gap IS NOT NULL GROUP BY 1, 2),
ex AS (SELECT study, series, count(*) AS n, count(proj) AS np, arg_max(proj, position) - arg_min(proj, position) AS ext FROM ord GROUP BY 1, 2)
SELECT e.study, e.series, CASE WHEN n >= 2 AND np = n THEN round(md, 4) END AS spacing_median, CASE WHEN n >= 2 AND np = n THEN round(mx, 4) END AS spacing_max,
  CASE WHEN n >= 2 AND np = n THEN round(ext, 3) END AS extent FROM ex e LEFT JOIN ag USING (study, series)""")
def e11(spark, d):
    return series.through_plane_geometry(series.order_slices(unique_headers(Tables(spark, d))))


@query("e12_series_qc", HBASE + f", {SLICE_SQL} " + f"""
, st AS (SELECT study, series, count(*) AS n, min(om) AS om, bool_or(tilt = 0) AS t0, bool_and(tilt = 0) AS t1, count(DISTINCT sop) AS ns, min(mode) AS mode, arg_min(tilt, path) = 0 AS ft FROM ord GROUP BY 1, 2),
tg AS (SELECT study, series, bool_or(abs(gap) < 1e-5) AS tight FROM (SELECT study, series, proj - lag(proj) OVER (PARTITION BY study, series ORDER BY position) AS gap FROM ord WHERE mode = 'iop_ipp') GROUP BY 1, 2)
SELECT st.study, st.series, n, CASE WHEN n < 3 THEN 'fewer_than_three_slices' WHEN om = 0 THEN 'missing_iop'
  WHEN CASE WHEN ft THEN 'Coronal' ELSE 'Axial' END <> CASE WHEN {sql_h("'pl:' || st.series")} % 10 = 0 THEN 'Sagittal' ELSE 'Axial' END THEN 'plane_metadata_geometry_mismatch'
  WHEN t0 AND NOT t1 THEN 'incoherent_orientation' WHEN ns <> n THEN 'duplicate_sop' WHEN mode = 'path_fallback_not_sop_lex' THEN 'missing_slice_order'
  WHEN coalesce(tight, false) THEN 'duplicate_slice_position' END AS reason FROM st LEFT JOIN tg USING (study, series)""")
def e12(spark, d):
    t = Tables(spark, d)
    hd = unique_headers(t)
    planes = t.headers.select("study", "series").distinct().withColumn(
        "plane", F.when(h("pl", F.col("series")) % 10 == 0, F.lit("Sagittal")).otherwise(F.lit("Axial")))
    return series.series_qc(hd, planes)


@query("e12_thinned_positions", """
SELECT doc_id, string_agg(p, ',' ORDER BY i) AS kept FROM (
  SELECT doc_id, i, round_even(i * ((n - 1)::DOUBLE / (least(n, 64) - 1)), 0)::INT::VARCHAR AS p FROM (SELECT doc_id, (n_chars % 200 + 3)::INT AS n FROM documents), range(64) r(i) WHERE i < least(n, 64)) GROUP BY 1""")
def e12_thin(spark, d):
    n = (F.col("n_chars") % 200 + 3).cast("int")
    return Tables(spark, d).raw("documents").select("doc_id", F.array_join(series.thinned_positions(n, 64), ",").alias("kept"))


def _centers_sql(formula: str, k: int) -> str:
    return f"(SELECT string_agg(({formula})::INT::VARCHAR, ',' ORDER BY i) FROM range({k}) r(i))"


@query("e13_series_centers", """
WITH d AS (SELECT doc_id, (n_chars % 60 + 1)::INT AS n FROM documents), c AS (SELECT doc_id, n, i, round_even(CASE WHEN n >= 3 THEN greatest(1, least(n - 2, x * (n - 1))) ELSE x * (n - 1) END, 0)::INT AS c
  FROM d, (SELECT i, 0.15::DOUBLE + 0.7::DOUBLE * i / 11 AS x FROM range(12) r(i)))
SELECT doc_id, n, string_agg(c::VARCHAR, ',' ORDER BY i) AS centers, 12 - count(DISTINCT c)::INT AS duplicates, (n // 2)::INT AS single FROM c GROUP BY 1, 2""")
def e13(spark, d):
    n = (F.col("n_chars") % 60 + 1).cast("int")
    c = arrays.series_centers(n, 12)
    return Tables(spark, d).raw("documents").select(
        "doc_id", n.alias("n"), F.array_join(c, ",").alias("centers"), arrays.duplicate_count(c).alias("duplicates"),
        arrays.series_centers(n, 1)[0].alias("single"))


@query("e14_evaluation_centers", """
WITH d AS (SELECT doc_id, (n_chars % 60 + 3)::INT AS n FROM documents), e AS (SELECT *, greatest(1.0::DOUBLE, 0.04::DOUBLE * (n - 1)) AS a0, least(n - 2.0::DOUBLE, 0.96::DOUBLE * (n - 1)) AS b0 FROM d),
f AS (SELECT doc_id, n, CASE WHEN b0 < a0 THEN (n - 1) / 2.0::DOUBLE ELSE a0 END AS a, CASE WHEN b0 < a0 THEN (n - 1) / 2.0::DOUBLE ELSE b0 END AS b FROM e)
SELECT doc_id, n, string_agg(greatest(1, least(n - 2, round_even(a + (b - a) * (i / 7.0::DOUBLE), 0)::INT))::VARCHAR, ',' ORDER BY i) AS centers FROM f, range(8) r(i) GROUP BY 1, 2""")
def e14(spark, d):
    n = (F.col("n_chars") % 60 + 3).cast("int")
    return Tables(spark, d).raw("documents").select("doc_id", n.alias("n"), F.array_join(arrays.evaluation_centers(n, 8), ",").alias("centers"))


@query("e15_neighbour_triplets", """
WITH d AS (SELECT doc_id, (n_chars % 60 + 1)::INT AS n FROM documents), c AS (SELECT doc_id, n, i, (n - 1) * i // 4 AS c FROM d, range(5) r(i))
SELECT doc_id, string_agg(greatest(0, c - 1) || '-' || c || '-' || least(n - 1, c + 1), ',' ORDER BY i) AS triplets FROM c GROUP BY 1""")
def e15(spark, d):
    n = (F.col("n_chars") % 60 + 1).cast("int")
    c = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.floor((n - 1) * i / 4).cast("int"))
    t = F.transform(arrays.neighbour_triplets(c, n), lambda x: F.array_join(x, "-"))
    return Tables(spark, d).raw("documents").select("doc_id", F.array_join(t, ",").alias("triplets"))


def _dealing(s: int, start: str) -> str:
    """CTEs of one part of the dealing (1: groups with gold): heavy groups one by one, the others where prefix sums level the folds."""
    least = f"list_position(g{s}.loads, list_min(g{s}.loads))"
    return f"""
g{s}(i, loads, fold) AS (SELECT 0::BIGINT, {start}, -1::BIGINT UNION ALL
  SELECT hv.i, list_transform(g{s}.loads, lambda x, j: x + CASE WHEN j = {least} THEN hv.w ELSE 0 END), {least} - 1 FROM g{s} JOIN hv ON hv.s = {s} AND hv.i = g{s}.i + 1),
e{s} AS (SELECT loads, (SELECT coalesce(sum(w), 0)::BIGINT FROM lt WHERE s = {s}) AS l FROM g{s} ORDER BY i DESC LIMIT 1),
p{s} AS (SELECT loads, list_min(list_transform(range(1, 6), lambda j: {{'v': (l + list_sum(list_sort(loads)[1:j]))::DOUBLE / j, 'j': j::BIGINT, 'p': (l + list_sum(list_sort(loads)[1:j]))::BIGINT}})) AS t FROM e{s}),
b{s} AS (SELECT t.j AS j, list_transform(range(1, 6), lambda k: list_sum(list_transform(loads[1:k], lambda x: greatest(0, t.p - t.j * x)))) AS bounds FROM p{s}),
d{s} AS (SELECT hv.group_id, hv.size, g{s}.fold::INT AS fold FROM hv JOIN g{s} ON hv.i = g{s}.i WHERE hv.s = {s}
  UNION ALL SELECT group_id, size, least(4, len(list_filter(bounds, lambda x: before * j >= x)))::INT FROM lt, b{s} WHERE s = {s})"""


DEAL = f"""un AS (SELECT g.uid, g.group_id, f.is_gold FROM grouped g JOIN folds f USING (uid)),
wt AS (SELECT *, (gold > 0)::INT AS s, CASE WHEN gold > 0 THEN gold ELSE size END AS w FROM (SELECT group_id, count(*) AS size, sum(is_gold::INT)::BIGINT AS gold, {sql_h(f"'{SEED}:' || group_id")} AS hh FROM un GROUP BY 1)),
sized AS (SELECT *, sum(w) OVER (PARTITION BY s) AS total FROM wt),
hv AS (SELECT group_id, s, w, size, row_number() OVER (PARTITION BY s ORDER BY w DESC, hh, group_id) AS i FROM sized WHERE w * 20 > total),
lt AS (SELECT group_id, s, w, size, (sum(w) OVER (PARTITION BY s ORDER BY hh, group_id) - w)::BIGINT AS before FROM sized WHERE w * 20 <= total),{_dealing(1, "[0, 0, 0, 0, 0]::BIGINT[]")},
{_dealing(0, "(SELECT list_transform(range(5), lambda k: coalesce(list_sum(list_transform(list_filter(list({'f': fold, 'n': size}), lambda x: x.f = k), lambda x: x.n)), 0)::BIGINT) FROM d1)")},
dealt AS (SELECT group_id, fold FROM d1 UNION ALL SELECT group_id, fold FROM d0)"""
RBASE = BASE.replace("WITH ", "WITH RECURSIVE ", 1)


@query("e16_group_folds", RBASE + f", {DEAL} SELECT group_id, fold FROM dealt")
def e16(spark, d):
    t = Tables(spark, d)
    return folds.deal_folds(t.folds.select("uid", "group_id", "is_gold"), 5, SEED)


GSPLIT = f"""gs AS (SELECT uid, CASE WHEN row_number() OVER (ORDER BY {sql_h(f"'{SEED}:gold:' || uid")}, uid) <= greatest(1, round_even(count(*) OVER () * 0.5::DOUBLE, 0)) THEN 'eval' ELSE 'train_image_ok' END AS gold_split FROM folds WHERE is_gold)"""


@query("e17_gold_split", BASE + f", {GSPLIT} SELECT uid, gold_split FROM gs")
def e17(spark, d):
    return folds.split_gold(Tables(spark, d).folds, 0.5, SEED)


@query("e18_all_gold_holdout", BASE + """
SELECT uid, fold, is_gold, CASE WHEN gold_split <> 'weak' THEN 'eval' ELSE 'weak' END AS gold_split, group_id,
  CASE gold_split WHEN 'eval' THEN 'A_historic_eval' WHEN 'train_image_ok' THEN 'B_former_train' ELSE '' END AS gold_set FROM folds""")
def e18(spark, d):
    return fold_plans.all_gold_holdout(Tables(spark, d).folds)["folds"]


@query("e19_first_decisive", f"""
WITH c AS (SELECT conv_id AS uid, turn AS chunk, role AS target, ['criterion_positive', 'explicit_negative', 'uncertain', 'not_mentioned', 'not_mentioned', 'not_mentioned', ''][{sql_h("'dec:' || conv_id || ':' || turn")} % 7 + 1] AS state, text AS span FROM conversations)
SELECT uid, target, coalesce(arg_min(state, chunk) FILTER (state NOT IN ('', 'not_mentioned')), 'not_mentioned') AS state, coalesce(arg_min(span, chunk) FILTER (state NOT IN ('', 'not_mentioned')), '') AS span FROM c GROUP BY 1, 2""")
def e19(spark, d):
    states = F.array(*[F.lit(s) for s in ("criterion_positive", "explicit_negative", "uncertain", "not_mentioned", "not_mentioned", "not_mentioned", "")])
    k = (h("dec", F.col("conv_id").cast("string"), F.col("turn").cast("string")) % 7).cast("int")
    rows = Tables(spark, d).raw("conversations").select(F.col("conv_id").alias("uid"), F.col("turn").alias("chunk"), F.col("role").alias("target"),
                                                        F.get(states, k).alias("state"), F.col("text").alias("span"))
    return extraction.first_decisive(rows)


@query("e20_latest_per_key", """
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def e20(spark, d):
    rows = Tables(spark, d).raw("events").select("user_id", "ts", "event_id", "event_type", "value")
    return extraction.latest_per_key(rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("e21_budget_admission", f"""
WITH rq AS (SELECT o_orderkey AS seq, 's' || o_orderkey AS uid, floor(o_totalprice)::BIGINT AS bytes FROM orders),
ex AS (SELECT uid, bytes // 2 AS bytes FROM rq WHERE {sql_h("'ex:' || uid")} % 5 = 0),
r AS (SELECT rq.seq, rq.uid, rq.bytes, (SELECT coalesce(sum(bytes), 0) FROM ex) + sum(rq.bytes - coalesce(ex.bytes, 0)) OVER (ORDER BY seq) AS projected FROM rq LEFT JOIN ex USING (uid)),
lim AS (SELECT (SELECT sum(bytes) FROM rq)::BIGINT * 7 // 10 AS l), f AS (SELECT min(seq) AS first FROM r, lim WHERE projected > l)
SELECT seq, uid, bytes, projected::BIGINT AS projected, CASE WHEN seq < first THEN 'admitted' WHEN seq = first THEN 'cache_budget_exceeded' ELSE 'not_attempted' END AS status FROM r, f""")
def e21(spark, d):
    rows = Tables(spark, d).raw("orders").select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("uid"),
                                                 F.floor("o_totalprice").alias("bytes"))
    have = rows.where(h("ex", F.col("uid")) % 5 == 0).select("uid", F.floor(F.col("bytes") / 2).alias("bytes"))
    limit = rows.agg(F.sum("bytes")).first()[0] * 7 // 10
    return manifest.admit_under_budget(rows, have, limit, "seq")


@query("e22_seeded_windows", f"""
WITH d AS (SELECT 'd' || doc_id AS uid, doc_id, n_chars FROM documents), v AS (SELECT uid, i FROM d, range(12) r(i) WHERE {sql_h("'val:' || doc_id || ':' || i")} % 3 > 0),
nv AS (SELECT uid, count(*) AS nv FROM v GROUP BY 1),
pick AS (SELECT uid, i FROM (SELECT v.uid, i, nv, row_number() OVER (PARTITION BY v.uid ORDER BY {sql_h("'5:0:' || v.uid || ':' || i")}, i) AS k FROM v JOIN nv USING (uid)) WHERE nv >= 6 AND k <= 6
  UNION ALL SELECT uid, i FROM (SELECT d.uid, r.i, row_number() OVER (PARTITION BY d.uid ORDER BY (v.i IS NULL), r.i) AS k, coalesce(nv, 0) AS nv FROM d CROSS JOIN range(12) r(i) LEFT JOIN v ON v.uid = d.uid AND v.i = r.i LEFT JOIN nv ON nv.uid = d.uid) WHERE nv < 6 AND k <= 6)
SELECT uid, string_agg(i::VARCHAR, ',' ORDER BY i) AS windows FROM pick GROUP BY 1""")
def e22(spark, d):
    n = F.col("doc_id").cast("string")
    valid = F.filter(F.sequence(F.lit(0), F.lit(11)), lambda i: h("val", n, i.cast("string")) % 3 > 0)
    uid = F.concat(F.lit("d"), n)
    return Tables(spark, d).raw("documents").select(
        uid.alias("uid"), F.array_join(arrays.seeded_subset(valid, F.lit(12), 6, 5, 0, uid), ",").alias("windows"))


@query("e23_hardest_cases", BASE + """
, c AS (SELECT a.model, a.target, a.uid AS pu, b.uid AS nu, CASE WHEN a.p < b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END::DOUBLE AS e
  FROM scored a JOIN scored b ON a.model = b.model AND a.target = b.target AND a.y = 1 AND b.y = 0)
SELECT model, target, pu AS uid, round(avg(e), 9) AS burden FROM c GROUP BY 1, 2, 3 UNION ALL SELECT model, target, nu, round(avg(e), 9) FROM c GROUP BY 1, 2, 3""")
def e23(spark, d):
    burden = auc.case_burden(Tables(spark, d).scored, ["model", "target"])
    return auc.hardest_cases(burden.select("model", "target", "uid", r9("burden").alias("burden")))


@query("g1_intersection", BASE + "SELECT uid FROM (SELECT DISTINCT uid FROM sources WHERE source = 's1' INTERSECT SELECT DISTINCT uid FROM sources WHERE source = 's2')")
def g1(spark, d):
    s = Tables(spark, d).sources
    return s.where("source = 's1'").select("uid").intersect(s.where("source = 's2'").select("uid"))


@query("g2_union", BASE + "SELECT uid FROM sources WHERE source = 's2' UNION SELECT uid FROM sources WHERE source = 's3'")
def g2(spark, d):
    s = Tables(spark, d).sources
    return s.where("source = 's2'").select("uid").union(s.where("source = 's3'").select("uid")).distinct()


@query("g3_except", BASE + "SELECT DISTINCT uid FROM sources WHERE source = 's1' EXCEPT SELECT uid FROM folds WHERE is_gold")
def g3(spark, d):
    t = Tables(spark, d)
    return t.sources.where("source = 's1'").select("uid").distinct().join(t.folds.where("is_gold").select("uid"), "uid", "left_anti")


@query("g4_set_difference", BASE + """
, a AS (SELECT DISTINCT uid FROM sources WHERE source = 's1'), b AS (SELECT DISTINCT uid FROM sources WHERE source = 's3')
SELECT uid, 'left_only' AS side FROM a WHERE uid NOT IN (SELECT uid FROM b) UNION ALL SELECT uid, 'right_only' FROM b WHERE uid NOT IN (SELECT uid FROM a)""")
def g4(spark, d):
    s = Tables(spark, d).sources
    return selection.set_difference(s.where("source = 's1'"), s.where("source = 's3'"), ["uid"])


MERGE = f"""pt AS (SELECT (l_orderkey % 4)::INT AS part, 's' || l_orderkey AS uid, floor(max(l_extendedprice))::BIGINT AS bytes FROM lineitem GROUP BY 1, 2 UNION ALL
  SELECT 4, 's' || o_orderkey, 7 FROM orders WHERE {sql_h("'ov:' || o_orderkey")} % 500 = 0)"""


def merge_parts(t):
    li = t.raw("lineitem").groupBy((F.col("l_orderkey") % 4).cast("int").alias("part"), F.concat(F.lit("s"), F.col("l_orderkey").cast("string")).alias("uid")).agg(
        F.floor(F.max("l_extendedprice")).alias("bytes"))
    o = t.raw("orders").where(h("ov", F.col("o_orderkey").cast("string")) % 500 == 0).select(
        F.lit(4).alias("part"), F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("uid"), F.lit(7).cast("long").alias("bytes"))
    return li.unionByName(o)


@query("g5_merge_violations", f"""WITH {MERGE} SELECT 'overlapping_parts' AS "check", uid AS key FROM pt GROUP BY uid HAVING count(*) > 1
UNION ALL SELECT 'different_policies', '2' UNION ALL SELECT 'part_stopped_on_budget', '3'""")
def g5(spark, d):
    parts = merge_parts(Tables(spark, d))
    head = parts.select("part").distinct().withColumn("policy_hash", F.when(F.col("part") == 4, "b").otherwise("a")).withColumn(
        "budget_error", F.when(F.col("part") == 3, "stopped"))
    return manifest.merge_violations(head, parts)


@query("g5_merge_summary", f"""WITH {MERGE}, q AS (SELECT uid FROM pt WHERE {sql_h("'qq:' || uid")} % 100 = 0), st AS (SELECT * FROM pt WHERE uid NOT IN (SELECT uid FROM q))
SELECT (SELECT count(*) FROM st) AS n_studies, (SELECT count(*) FROM pt) AS n_requested, (SELECT count(*) FROM q) AS n_quarantine, (SELECT sum(bytes)::BIGINT FROM st) AS byte_total,
  (SELECT count(*) FROM q) = 0 AS requested_complete""")
def g5_summary(spark, d):
    parts = merge_parts(Tables(spark, d))
    q = h("qq", F.col("uid")) % 100 == 0
    return manifest.merge_summary(parts.where(~q), parts.select("uid"), parts.where(q).select("uid"))


CONF = """ent AS (SELECT s_suppkey::VARCHAR AS arm, 's_nationkey' AS key, s_nationkey::VARCHAR AS value FROM supplier UNION ALL SELECT s_suppkey::VARCHAR, 's_name', s_name FROM supplier
  UNION ALL SELECT s_suppkey::VARCHAR, 'even', (s_acctbal > 5000)::VARCHAR FROM supplier),
ctl AS (SELECT s_suppkey::VARCHAR AS arm, (s_suppkey - s_suppkey % 10)::VARCHAR AS control FROM supplier WHERE s_suppkey % 10 > 0),
chg AS (SELECT c.arm, a.key FROM ctl c JOIN ent a ON a.arm = c.arm JOIN ent b ON b.arm = c.control AND b.key = a.key WHERE a.value IS DISTINCT FROM b.value)"""


def _config(t):
    s = t.raw("supplier").withColumn("even", F.col("s_acctbal") > 5000)
    entries = configdiff.melt(s, "s_suppkey", ["s_nationkey", "s_name", "even"])
    k = F.col("s_suppkey")
    controls = s.where(k % 10 > 0).select(k.cast("string").alias("arm"), (k - k % 10).cast("string").alias("control"))
    return entries, controls


@query("g6_controlled_changes", f"WITH {CONF} SELECT arm, key FROM chg")
def g6(spark, d):
    return configdiff.controlled_changes(*_config(Tables(spark, d)))


@query("g6_undeclared_changes", f"WITH {CONF}, dec AS (SELECT arm, 's_name' AS key FROM ctl UNION ALL SELECT arm, 'even' FROM ctl) " + """
SELECT arm, key, 'undeclared' AS side FROM chg WHERE (arm, key) NOT IN (SELECT arm, key FROM dec) UNION ALL SELECT arm, key, 'declared_but_equal' FROM dec WHERE (arm, key) NOT IN (SELECT arm, key FROM chg)""")
def g6_undeclared(spark, d):
    entries, controls = _config(Tables(spark, d))
    declared = controls.select("arm", F.explode(F.array(F.lit("s_name"), F.lit("even"))).alias("key"))
    return configdiff.undeclared_changes(configdiff.controlled_changes(entries, controls), declared)


@query("g6_flatten_config", """
SELECT p_partkey::VARCHAR AS arm, 'brand' AS key, p_brand AS value FROM part UNION ALL SELECT p_partkey::VARCHAR, 'train.size', p_size::VARCHAR FROM part UNION ALL SELECT p_partkey::VARCHAR, 'train.type', p_type FROM part""")
def g6_flatten(spark, d):
    rows = Tables(spark, d).raw("part").select(F.col("p_partkey").cast("string").alias("arm"), F.to_json(F.struct(
        F.col("p_brand").alias("brand"), F.col("p_name").alias("ignored"), F.struct(F.col("p_size").alias("size"), F.col("p_type").alias("type")).alias("train"))).alias("config"))
    return configdiff.flatten_config(rows, ["brand"])


@query("g7_pin_mismatches", """
SELECT c_custkey::VARCHAR AS record, 'c_name' AS field FROM customer WHERE c_custkey % 9 = 0 UNION ALL SELECT c_custkey::VARCHAR, 'c_mktsegment' FROM customer WHERE c_custkey % 14 = 0""")
def g7(spark, d):
    c = Tables(spark, d).raw("customer")
    want = configdiff.melt(c, "c_custkey", ["c_name", "c_mktsegment"]).toDF("record", "field", "value")
    k = F.col("record").cast("long")
    seen = want.withColumn("value", F.when((k % 9 == 0) & (F.col("field") == "c_name"), F.lit("changed")).otherwise(F.col("value"))).where(
        ~((k % 14 == 0) & (F.col("field") == "c_mktsegment")))
    return configdiff.pin_mismatches(want, seen)


@query("k15_receipt_violations", BASE + f"""
, sh AS (SELECT uid, ((row_number() OVER (ORDER BY uid) - 1) % 6)::INT AS shard FROM train),
ag AS (SELECT shard, count(*) AS n FROM sh GROUP BY 1)
SELECT shard, CASE shard WHEN 1 THEN 'count_mismatch' WHEN 2 THEN 'ids_mismatch' WHEN 3 THEN 'job_not_complete' ELSE 'receipt_missing' END AS "check" FROM ag WHERE shard IN (1, 2, 3, 4)""")
def k15(spark, d):
    shards = id_list_fingerprint(selection.id_shards(Tables(spark, d).train, 6), "uid", ["shard"])
    s = F.col("shard")
    receipts = shards.where(s != 4).select("shard", F.when(s == 3, "error").otherwise("ok").alias("status"),
                                           F.when(s == 1, F.col("n_ids") - 1).otherwise(F.col("n_ids")).alias("n_studies"),
                                           F.when(s == 2, F.lit("0")).otherwise(F.col("ids_sha256")).alias("ids_sha256"))
    return manifest.receipt_violations(receipts, shards)


