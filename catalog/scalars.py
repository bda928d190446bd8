"""Scalar and array functions."""

from pyspark.sql import functions as F

from catalog import query
from catalog.base import BASE, TARGETS, Tables, h, r9, sql_h
from catalog.scans import ENV_SQL, digest_sql, envelopes, fingerprint_sql, row_digest_sql
from tallyfold.functions import arrays, geometry, hashing, predicates, text
from tallyfold.operators import calibration, extraction, labels, ranks, series


@query("h1_sha256_text", "SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents")
def h1(spark, d):
    return Tables(spark, d).raw("documents").select("doc_id", hashing.sha256_text(F.col("text")).alias("h"))


@query("h2_table_fingerprint", f"SELECT (SELECT count(*) FROM orders) AS n_rows, {fingerprint_sql('orders', ['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_orderpriority'])} AS fingerprint")
def h2(spark, d):
    return hashing.table_fingerprint(Tables(spark, d).raw("orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


@query("h2_differing_ranges", f"""
WITH a AS (SELECT substr({row_digest_sql(["o_orderkey", "o_custkey", "o_orderstatus"])}, 1, 2) AS range, o_orderkey FROM orders),
b AS (SELECT substr({row_digest_sql(["o_orderkey", "o_custkey", "o_orderstatus"])}, 1, 2) AS range, o_orderkey FROM (SELECT o_orderkey, o_custkey + (o_orderkey % 997 = 1)::INT AS o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 1009 <> 5)),
diff AS (SELECT range FROM ((SELECT range, o_orderkey FROM a EXCEPT SELECT range, o_orderkey FROM b) UNION (SELECT range, o_orderkey FROM b EXCEPT SELECT range, o_orderkey FROM a))
  UNION SELECT range FROM a JOIN b USING (range, o_orderkey) WHERE o_orderkey % 997 = 1)
SELECT range, (SELECT count(*) FROM a WHERE a.range = diff.range) AS n_left, (SELECT count(*) FROM b WHERE b.range = diff.range) AS n_right FROM diff""")
def h2_ranges(spark, d):
    """Two versions of a table: some cells changed, some rows missing."""
    o = Tables(spark, d).raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    other = o.where("o_orderkey % 1009 <> 5").withColumn("o_custkey", F.col("o_custkey") + (F.col("o_orderkey") % 997 == 1).cast("int"))
    return hashing.differing_ranges(o, other, ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("h2_id_list_fingerprint", BASE + "SELECT fold, count(*) AS n_ids, " + digest_sql(["uid"]) + " AS ids_sha256 FROM folds GROUP BY 1")
def h2_ids(spark, d):
    return hashing.id_list_fingerprint(Tables(spark, d).folds, "uid", ["fold"])


@query("h3_canonical_json", """SELECT s_suppkey, '{"a":' || s_nationkey || ',"b":"' || s_name || '","c":null}' AS j, sha256('{"a":' || s_nationkey || ',"b":"' || s_name || '","c":null}') AS k FROM supplier""")
def h3(spark, d):
    fields = {"c": F.lit(None).cast("string"), "b": F.col("s_name"), "a": F.col("s_nationkey")}
    return Tables(spark, d).raw("supplier").select("s_suppkey", hashing.canonical_json(fields).alias("j"), hashing.canonical_hash(fields).alias("k"))


@query("h3_resume_key", BASE + """
SELECT uid, sha256('{"evidence_policy":"e1","model":"m","ontology":"o1","prompt_hash":"p","report_hash":"' || sha256(report) || '","revision":"r","uid":"' || uid || '"}') AS k FROM train""")
def h3_key(spark, d):
    lit = F.lit
    return Tables(spark, d).train.select("uid", hashing.resume_key(
        F.col("uid"), F.col("report"), lit("m"), lit("r"), lit("p"), lit("o1"), lit("e1")).alias("k"))


REPLY = f"""rp AS (SELECT event_id, props, {sql_h("'rep:' || event_id")} % 6 AS k FROM events)"""


def replies(t):
    k = h("rep", F.col("event_id").cast("string")) % 6
    p = F.col("props")
    body = (F.when(k == 0, F.concat(F.lit("```json\n"), p, F.lit("\n```"))).when(k == 1, F.concat(F.lit("  ```"), p, F.lit("```  ")))
            .when(k == 2, F.lit("{}")).when(k == 3, F.lit("[1, 2]")).when(k == 4, F.concat(p, F.lit("}"))).otherwise(p))
    return t.raw("events").select("event_id", k.alias("k"), p.alias("props"), body.alias("content"))


@query("h4_parse_json_content", f"""WITH {REPLY} SELECT event_id, CASE k WHEN 2 THEN '{{}}' WHEN 3 THEN '[1, 2]' WHEN 4 THEN props || '}}' ELSE props END AS body,
  CASE WHEN k IN (2, 3) THEN 'empty_or_non_object' WHEN k = 4 THEN 'invalid_json' END AS error FROM rp""")
def h4(spark, d):
    return replies(Tables(spark, d)).select("event_id", text.parse_json_content(F.col("content")).alias("x")).select(
        "event_id", F.col("x.text").alias("body"), "x.error")


@query("h5_select_message", f"""
WITH x AS (SELECT event_id, props, {sql_h("'msg:' || event_id")} % 8 AS k FROM events)
SELECT event_id, CASE WHEN k IN (0, 1) THEN 'content' WHEN k = 2 THEN 'reasoning_content' END AS field, CASE WHEN k < 3 THEN props END AS raw,
  CASE k WHEN 3 THEN 'truncated_response' WHEN 4 THEN 'empty_content' WHEN 5 THEN 'reasoning_not_json_object' WHEN 6 THEN 'empty_or_non_object' WHEN 7 THEN 'invalid_json' END AS reason FROM x""")
def h5(spark, d):
    k = h("msg", F.col("event_id").cast("string")) % 8
    p = F.col("props")
    content = F.when(k.isin(0, 1, 3), p).when(k == 6, F.lit("{}")).when(k == 7, F.lit("{oops")).otherwise(F.lit("  "))
    reasoning = F.when(k == 2, p).when(k == 4, F.lit("")).when(k == 5, F.lit("I think {}"))
    finish = F.when(k == 3, F.lit("length")).when(k == 1, F.lit("stop"))
    picked = text.select_message(content, reasoning, finish, F.lit(True))
    return Tables(spark, d).raw("events").select("event_id", picked.alias("x")).select("event_id", "x.*")


@query("h6_envelope_uid", BASE + f", {ENV_SQL} SELECT uid, reason FROM (SELECT CASE WHEN k IN (0, 1) THEN NULL ELSE uid END AS uid, CASE WHEN k IN (0, 1) THEN reason END AS reason FROM env)")
def h6(spark, d):
    rows = envelopes(Tables(spark, d))
    return rows.select(labels.envelope_uid(F.coalesce("StudyInstanceUID", "uid"), F.col("payload.StudyInstanceUID")).alias("x")).select("x.*")


@query("h7_envelope_reasons", BASE + f", {ENV_SQL} SELECT reason, count(*) AS n FROM env WHERE reason IS NOT NULL GROUP BY 1")
def h7(spark, d):
    return labels.reject_reasons(labels.tag_envelopes(envelopes(Tables(spark, d))))


VAL = f"""vx AS (SELECT uid, report, target, {sql_h("'v:' || target || ':' || uid")} % 9 AS k FROM train, tgt),
ve AS (SELECT uid, CASE WHEN k = 0 THEN target || ':missing_evidence' WHEN k = 1 THEN target || ':evidence_not_in_report' WHEN k = 2 THEN target || ':bad_state:maybe'
  WHEN k = 3 THEN target || ':missing_field:criterion_mapping' WHEN k = 4 THEN target || ':evidence_not_in_report' WHEN k = 5 THEN 'missing_targets:' || target END AS e, k FROM vx),
vm AS (SELECT uid, string_agg(target, ',' ORDER BY target) AS m FROM vx WHERE k = 5 GROUP BY 1),
va AS (SELECT uid, e FROM ve WHERE k < 5 UNION ALL SELECT uid, 'missing_targets:' || m FROM vm UNION ALL SELECT uid, 'unknown_targets:extra' FROM train WHERE {sql_h("'x:' || uid")} % 11 = 0
  UNION ALL SELECT uid, 'extra:missing_evidence' FROM train WHERE {sql_h("'x:' || uid")} % 11 = 0)"""


def payloads(t):
    """Findings quoting their report, each with one way to be wrong."""
    k = h("v", F.col("target"), F.col("uid")) % 9
    quote = F.substring("report", 1, 12)
    f = F.struct(
        F.when(k == 2, "maybe").when(k == 4, "not_mentioned").when(k == 6, "not_mentioned").otherwise("criterion_positive").alias("state"),
        F.when(k == 0, F.lit("")).when(k.isin(1, 4), F.lit("☃ snow")).when(k == 6, F.lit("")).otherwise(quote).alias("evidence_span"),
        F.when(k != 3, F.lit("x")).alias("criterion_mapping"))
    cells = t.train.select("uid", "report", F.explode(F.array(*[F.lit(n) for n in TARGETS])).alias("target")).where(k != 5).select(
        "uid", F.struct("target", f.alias("f")).alias("e"))
    extra = t.train.where(h("x", F.col("uid")) % 11 == 0).select("uid", F.struct(F.lit("extra").alias("target"), F.struct(
        F.lit("uncertain").alias("state"), F.lit("").alias("evidence_span"), F.lit("x").alias("criterion_mapping")).alias("f")).alias("e"))
    maps = cells.unionByName(extra).groupBy("uid").agg(F.map_from_entries(F.sort_array(F.collect_list("e"))).alias("targets"))
    empty = F.map_from_entries(F.array().cast("array<struct<target:string,f:struct<state:string,evidence_span:string,criterion_mapping:string>>>"))
    return t.train.select("uid", "report").join(maps, "uid", "left").withColumn("targets", F.coalesce("targets", empty))


@query("h8_validation_errors", BASE + f", {VAL} SELECT t.uid, CASE WHEN {sql_h("'who:' || t.uid")} % 30 = 0 THEN 'uid_mismatch' ELSE coalesce((SELECT string_agg(e, ';' ORDER BY e) FROM va WHERE va.uid = t.uid), '') END AS errors FROM train t")
def h8(spark, d):
    found = F.when(h("who", F.col("uid")) % 30 == 0, F.lit("someone")).otherwise(F.col("uid"))
    errors = extraction.validation_errors(found, F.col("uid"), F.col("targets"), F.col("report"), TARGETS)
    return payloads(Tables(spark, d)).select("uid", F.array_join(errors, ";").alias("errors"))


@query("h9_recover_span", BASE + r"""
, sp AS (SELECT uid, report, CASE WHEN doc_id % 5 = 0 THEN substr(report, 4, 30) WHEN doc_id % 5 = 1 THEN substr(report, 4, 30) || '!~' WHEN doc_id % 5 = 2 THEN replace(substr(report, 4, 2), ' ', chr(10))
   ELSE replace(substr(report, 4, 60), ' ', '  ' || chr(10)) END AS span FROM train),
m AS (SELECT *, array_to_string(list_transform(string_split_regex(span, '\s+'), lambda x: regexp_escape(x)), '\s+') AS pat FROM sp),
c AS (SELECT *, span <> '' AND NOT contains(report, span) AND len(regexp_extract_all(report, pat)) = 1 AS rep FROM m)
SELECT uid, CASE WHEN rep THEN regexp_extract(report, pat) ELSE span END AS span, rep AS repaired FROM c""")
def h9(spark, d):
    k = F.col("doc_id") % 5
    head = F.substring("report", 4, 30)
    span = (F.when(k == 0, head).when(k == 1, F.concat(head, F.lit("!~"))).when(k == 2, F.replace(F.substring("report", 4, 2), F.lit(" "), F.lit("\n")))
            .otherwise(F.replace(F.substring("report", 4, 60), F.lit(" "), F.lit("  \n"))))
    return Tables(spark, d).train.select("uid", text.recover_span(span, F.col("report")).alias("x")).select("uid", "x.*")


@query("h10_split_report", """
WITH RECURSIVE r AS (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS report FROM documents),
p AS (SELECT doc_id, report, string_split(report, chr(10) || chr(10)) AS ps FROM r),
st(doc_id, i, buf, done) AS (
  SELECT doc_id, 0, '', []::VARCHAR[] FROM p
  UNION ALL
  SELECT st.doc_id, i + 1, CASE WHEN buf <> '' AND length(buf) + 2 + length(ps[i + 1]) > 1500 OR buf = '' THEN ps[i + 1] ELSE buf || chr(10) || chr(10) || ps[i + 1] END,
    CASE WHEN buf <> '' AND length(buf) + 2 + length(ps[i + 1]) > 1500 THEN list_append(done, buf) ELSE done END
  FROM st JOIN p USING (doc_id) WHERE i < len(ps) AND length(report) > 1500 AND list_max(list_transform(ps, lambda x: length(x))) <= 1500),
fin AS (SELECT st.doc_id, CASE WHEN buf <> '' THEN list_append(done, buf) ELSE done END AS chunks FROM st JOIN p USING (doc_id) WHERE i = len(ps))
SELECT p.doc_id, CASE WHEN length(report) <= 1500 THEN 1 WHEN chunks IS NULL THEN -1 ELSE len(chunks) END::INT AS n_chunks,
  CASE WHEN length(report) <= 1500 THEN sha256(report) ELSE sha256(array_to_string(chunks, '|')) END AS h FROM p LEFT JOIN fin USING (doc_id)""")
def h10(spark, d):
    rows = Tables(spark, d).raw("documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("report"))
    chunks = text.split_report(F.col("report"), F.lit(1500))
    return rows.withColumn("c", chunks).select("doc_id", F.coalesce(F.nullif(F.size("c"), F.lit(-1)), F.lit(-1)).alias("n_chunks"), F.sha2(F.array_join("c", "|"), 256).alias("h"))


@query("h11_context_chars", "SELECT p_partkey, greatest(512, p_size * 100 - p_partkey % 900 - 256) * 4 AS chars FROM part")
def h11(spark, d):
    return Tables(spark, d).raw("part").select("p_partkey", text.context_chars(F.col("p_size") * 100, F.col("p_partkey") % 900).alias("chars"))


def vec(t):
    return t.raw("embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double") * 1000.0).alias("values"))


VEC = """v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE * 1000.0::DOUBLE) AS vals FROM embeddings),
u AS (SELECT vec_id, label, generate_subscripts(vals, 1) - 1 AS i, unnest(vals) AS x FROM v)"""


@query("h12_rescale_invert", f"""WITH {VEC}, s AS (SELECT vec_id, i, x * 2.0::DOUBLE + (-5.0)::DOUBLE AS y FROM u)
SELECT vec_id, i::INT AS i, round(CASE WHEN vec_id % 2 = 0 THEN max(y) OVER (PARTITION BY vec_id) - y ELSE y END, 6) AS v FROM s""")
def h12(spark, d):
    photo = F.when(F.col("vec_id") % 2 == 0, "monochrome1").otherwise("MONOCHROME2")
    out = arrays.invert_monochrome(arrays.rescale(F.col("values"), F.lit(2.0), F.lit(-5.0)), photo)
    return vec(Tables(spark, d)).select("vec_id", F.posexplode(out).alias("i", "v")).select("vec_id", "i", F.round("v", 6).alias("v"))


UNIT = """w AS (SELECT vec_id, quantile_cont(x, 0.005) AS lo, quantile_cont(x, 0.995) AS hi FROM u GROUP BY 1),
q AS (SELECT u.vec_id, i, (greatest(lo, least(hi, x)) - lo) / (hi - lo) AS x FROM u JOIN w USING (vec_id))"""


@query("h13_percentile_unit", f"WITH {VEC}, {UNIT} SELECT vec_id, i::INT AS i, round(x, 6) AS v FROM q")
def h13(spark, d):
    out = arrays.to_unit(arrays.percentile_clip(F.col("values")))
    return vec(Tables(spark, d)).select("vec_id", F.posexplode(out).alias("i", "v")).select("vec_id", "i", F.round("v", 6).alias("v"))


@query("h14_series_window", f"""WITH {VEC} SELECT label, round(quantile_cont(x, 0.005), 6) AS lo, round(quantile_cont(x, 0.995), 6) AS hi FROM u GROUP BY 1""")
def h14(spark, d):
    rows = vec(Tables(spark, d)).select(F.lit("s").alias("study"), F.col("label").alias("series"), "values")
    return series.series_window(rows).select(F.col("series").alias("label"), F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query("h15_uint8", """
WITH u AS (SELECT doc_id, (n_chars % 1003)::DOUBLE / 1000.0::DOUBLE - 0.001::DOUBLE AS x FROM documents), q AS (SELECT doc_id, floor(greatest(0.0::DOUBLE, least(255.0::DOUBLE, x * 255.0::DOUBLE)))::INT AS q FROM u)
SELECT doc_id, q, round(q / 255.0::DOUBLE, 9) AS back FROM q""")
def h15(spark, d):
    x = F.array((F.col("n_chars") % 1003).cast("double") / 1000.0 - 0.001)
    q = arrays.encode_uint8(x)
    return Tables(spark, d).raw("documents").select("doc_id", q[0].alias("q"), r9(arrays.decode_uint8(q)[0]).alias("back"))


@query("h16_crop_box", """
WITH x AS (SELECT p_partkey, (200 + p_size * 10)::INT AS rr, (300 + p_partkey % 200)::INT AS cc, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN 0.0::DOUBLE ELSE (p_size % 7 + 3)::DOUBLE / 10 END AS s FROM part),
y AS (SELECT *, CASE WHEN s > 0 THEN least(rr, greatest(1, round_even(160.0::DOUBLE / s, 0)::BIGINT)) ELSE least(rr, cc) END AS hh, CASE WHEN s > 0 THEN least(cc, greatest(1, round_even(160.0::DOUBLE / s, 0)::BIGINT)) ELSE least(rr, cc) END AS ww FROM x)
SELECT p_partkey, greatest(0, (rr - hh) // 2)::BIGINT AS r0, (greatest(0, (rr - hh) // 2) + hh)::BIGINT AS r1, greatest(0, (cc - ww) // 2)::BIGINT AS c0, (greatest(0, (cc - ww) // 2) + ww)::BIGINT AS c1,
  CASE WHEN s > 0 THEN 'pixel_spacing_mm' ELSE 'missing_spacing_square_fallback' END AS mode FROM y""")
def h16(spark, d):
    k = F.col("p_partkey") % 9
    s = F.when(k == 1, F.lit(0.0)).otherwise((F.col("p_size") % 7 + 3).cast("double") / 10)
    spacing = F.when(k != 0, F.array(s, s))
    rr, cc = (F.lit(200) + F.col("p_size") * 10).cast("int"), (F.lit(300) + F.col("p_partkey") % 200).cast("int")
    return Tables(spark, d).raw("part").select("p_partkey", geometry.crop_box(rr, cc, spacing).alias("b")).select("p_partkey", "b.*")


ORI = f"""o AS (SELECT p_partkey, {sql_h("'ori:' || p_partkey")} % 8 AS k, ({sql_h("'pl:' || p_partkey")} % 3)::INT AS plane FROM part),
io AS (SELECT *, CASE k WHEN 0 THEN [1.0, 0, 0, 0, 1, 0] WHEN 1 THEN [0.0, 1, 0, 1, 0, 0] WHEN 2 THEN [0.0, 1, 0, 0, 0, -1] WHEN 3 THEN [0.0, 0, -1, 0, 1, 0] WHEN 4 THEN [1.0, 0, 0, 0, 0, -1] WHEN 5 THEN [-1.0, 0, 0, 0, 0, 1]
   WHEN 6 THEN [0.6, 0.6, 0.5, 0.5, 0.5, 0.7] END::DOUBLE[] AS iop, plane IN (1, 2) AS c0 FROM o),
ax AS (SELECT *, CASE plane WHEN 0 THEN 2 ELSE 1 END AS ca, CASE plane WHEN 2 THEN 2 ELSE 3 END AS ra, CASE plane WHEN 2 THEN 1 ELSE -1 END AS rs FROM io),
tr AS (SELECT *, abs(iop[ca]) < abs(iop[ra]) AS t FROM ax), di AS (SELECT *, CASE WHEN t THEN iop[ca + 3] ELSE iop[ca] END AS cd, CASE WHEN t THEN iop[ra] ELSE iop[ra + 3] END AS rd FROM tr),
re AS (SELECT *, CASE WHEN iop IS NULL THEN 'missing_iop' WHEN p_partkey % 10 = 0 THEN 'missing_or_invalid_spacing' WHEN abs(cd) < 0.7 OR abs(rd) < 0.7 THEN 'unsupported_in_plane_geometry' END AS reason FROM di)"""


@query("h17_orientation", f"""WITH {ORI} SELECT p_partkey, CASE WHEN reason IS NULL THEN t END AS transpose, CASE WHEN reason IS NULL THEN cd < 0 END AS flip_col, CASE WHEN reason IS NULL THEN rd * rs < 0 END AS flip_row,
  CASE WHEN reason IS NULL THEN CASE WHEN t THEN 0.8::DOUBLE ELSE 0.5::DOUBLE END END AS s0, CASE WHEN reason IS NULL THEN CASE WHEN t THEN 0.5::DOUBLE ELSE 0.8::DOUBLE END END AS s1, reason FROM re""")
def h17(spark, d):
    key = F.col("p_partkey").cast("string")
    k, plane = h("ori", key) % 8, (h("pl", key) % 3).cast("int")
    boxes = [(1, 0, 0, 0, 1, 0), (0, 1, 0, 1, 0, 0), (0, 1, 0, 0, 0, -1), (0, 0, -1, 0, 1, 0), (1, 0, 0, 0, 0, -1), (-1, 0, 0, 0, 0, 1), (.6, .6, .5, .5, .5, .7)]
    iop = F.when(k == 0, F.array(*[F.lit(float(x)) for x in boxes[0]]))
    for i, b in enumerate(boxes[1:], 1):
        iop = iop.when(k == i, F.array(*[F.lit(float(x)) for x in b]))
    spacing = F.when(F.col("p_partkey") % 10 != 0, F.array(F.lit(0.5), F.lit(0.8)))
    rows = Tables(spark, d).raw("part").select("p_partkey", iop.alias("iop"), spacing.alias("sp"), plane.alias("plane"))
    return rows.select("p_partkey", geometry.orientation(F.col("iop"), F.col("sp"), F.col("plane")).alias("x")).select("p_partkey", "x.*")


@query("h17_resample_box", """
WITH x AS (SELECT p_partkey, (200 + p_size * 10)::INT AS rr, (300 + p_partkey % 200)::INT AS cc, (p_size % 7 + 3)::DOUBLE / 10 AS s0, (p_size % 5 + 4)::DOUBLE / 10 AS s1 FROM part),
y AS (SELECT *, least(rr, greatest(1, round_even(153.6::DOUBLE / s0, 0)::BIGINT)) AS hh, least(cc, greatest(1, round_even(153.6::DOUBLE / s1, 0)::BIGINT)) AS ww FROM x),
z AS (SELECT *, greatest(1, least(384, round_even(hh * s0 / (153.6::DOUBLE / 384), 0)::BIGINT)) AS nh, greatest(1, least(384, round_even(ww * s1 / (153.6::DOUBLE / 384), 0)::BIGINT)) AS nw FROM y)
SELECT p_partkey, ((rr - hh) // 2)::BIGINT AS y, ((cc - ww) // 2)::BIGINT AS x, hh::BIGINT AS h, ww::BIGINT AS w, nh::BIGINT AS new_h, nw::BIGINT AS new_w, (384 - nh)::BIGINT AS pad_h, (384 - nw)::BIGINT AS pad_w FROM z""")
def h17_box(spark, d):
    rr, cc = (F.lit(200) + F.col("p_size") * 10).cast("int"), (F.lit(300) + F.col("p_partkey") % 200).cast("int")
    s0, s1 = (F.col("p_size") % 7 + 3).cast("double") / 10, (F.col("p_size") % 5 + 4).cast("double") / 10
    return Tables(spark, d).raw("part").select("p_partkey", geometry.resample_box(rr, cc, s0, s1, 384, 153.6).alias("b")).select("p_partkey", "b.*")


@query("h18_laterality_mismatch", "SELECT p_partkey, left(p_name, 1) IN ('l', 'r') AND lower(left(p_type, 1)) IN ('l', 'r', 's') AND false OR (lower(left(p_name, 1)) IN ('l', 'r') AND CASE p_partkey % 3 WHEN 0 THEN 'l' WHEN 1 THEN 'r' ELSE '' END IN ('l', 'r') AND lower(left(p_name, 1)) <> CASE p_partkey % 3 WHEN 0 THEN 'l' WHEN 1 THEN 'r' ELSE '' END) AS flip FROM part")
def h18(spark, d):
    k = F.col("p_partkey") % 3
    asked = F.when(k == 0, "Left").when(k == 1, "RIGHT").otherwise("")
    return Tables(spark, d).raw("part").select("p_partkey", predicates.laterality_mismatch(F.col("p_name"), asked).alias("flip"))


@query("h19_sigmoid_shrink_mix", "SELECT c_custkey, round(1 / (1 + exp(-greatest(-60, least(60, c_acctbal / 100)))), 9) AS s, round((c_nationkey / (c_nationkey + 8.0::DOUBLE)) * 0.25 + (1 - c_nationkey / (c_nationkey + 8.0::DOUBLE)) * 0.5, 9) AS shrunk FROM customer")
def h19(spark, d):
    return Tables(spark, d).raw("customer").select("c_custkey", r9(predicates.sigmoid(F.col("c_acctbal") / 100)).alias("s"),
                                                   r9(calibration.shrink(F.lit(0.25), F.col("c_nationkey"))).alias("shrunk"))


@query("h20_mirrored_mean", BASE + "SELECT a.uid, a.target, a.p AS p_plain, round((a.p + b.p) / 2, 9) AS p FROM preds a JOIN preds b USING (uid, target) WHERE a.model = 'm1' AND b.model = 'm2'")
def h20(spark, d):
    rows = Tables(spark, d).preds.where("model IN ('m1', 'm2')").withColumn("pass", F.when(F.col("model") == "m1", "plain").otherwise("mirrored"))
    return ranks.mirrored_mean(rows).withColumn("p", r9("p"))


@query("h21_remote_score", """
WITH x AS (SELECT event_id, event_type, CASE WHEN event_id % 7 = 0 THEN 'none' WHEN event_id % 7 = 1 THEN 'nan' WHEN event_id % 7 = 2 THEN '1.5' ELSE ((event_id % 100)::DOUBLE / 100)::VARCHAR END AS s FROM events)
SELECT event_id, upper(event_type) AS status, CASE WHEN s IN ('none', 'nan', '1.5') THEN NULL ELSE s::DOUBLE END AS score FROM x""")
def h21(spark, d):
    k = F.col("event_id")
    s = F.when(k % 7 == 0, "none").when(k % 7 == 1, "nan").when(k % 7 == 2, "1.5").otherwise(((k % 100).cast("double") / 100).cast("string"))
    return Tables(spark, d).raw("events").select("event_id", predicates.remote_status(F.concat(F.lit("Job.State."), "event_type")).alias("status"),
                                                 predicates.remote_score(s).alias("score"))


@query("h22_linear_head", """
WITH w AS (SELECT 't' || vec_id AS target, list_transform(embedding, lambda x: x::DOUBLE) AS w, vec_id::DOUBLE / 10 AS b FROM embeddings WHERE vec_id < 3),
x AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
SELECT vec_id, target, round(1 / (1 + exp(-(list_dot_product(v, w) + b))), 8) AS p FROM x, w""")
def h22(spark, d):
    e = Tables(spark, d).raw("embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("pooled"))
    head = e.where("vec_id < 3").select(F.concat(F.lit("t"), F.col("vec_id").cast("string")).alias("target"), F.col("pooled").alias("weights"),
                                        (F.col("vec_id").cast("double") / 10).alias("bias"))
    return calibration.linear_scores(e, head, ["vec_id"]).select("vec_id", "target", F.round("p", 8).alias("p"))
