"""Known answers for label rules, evidence, folds and pools."""

import json

import pytest
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.functions import predicates as P
from tallyfold.functions import text
from tallyfold.operators import calibration, contracts, extraction, folds, labels, selection, softlabels
from tallyfold.plans import folds as fold_plans
from tallyfold.plans import labels as label_plans
from tallyfold.sources import readers

TWELVE = ("ACL", "MCL", "Medial Meniscus", "Lateral Meniscus", "Medial OA", "Lateral OA", "PF OA", "Effusion", "Synovitis",
          "Baker's", "Contusion", "Fracture")


def train_table(spark):
    rows = [(f"s{i}", f"report {i // 5}", *[str(i % 2) if i < 8 else "" for _ in TWELVE]) for i in range(20)]
    return spark.createDataFrame(rows, schemas.all_strings(["uid", "report", *TWELVE]))


def test_duplicate_groups_and_folds(spark):
    train = train_table(spark)
    assert folds.duplicate_text_groups(train, "uid", "report").count() == 4
    made = fold_plans.make_folds(train, TWELVE, seed=7)
    rows = made["folds"].collect()
    assert len(rows) == 20 and sum(r.is_gold for r in rows) == 8
    by_group = {}
    for r in rows:
        by_group.setdefault(r.group_id, set()).add(r.fold)
    assert len(by_group) == 4 and all(len(f) == 1 for f in by_group.values())
    again = fold_plans.make_folds(train.repartition(3), TWELVE, seed=7)["folds"].collect()
    assert {r.uid: (r.fold, r.gold_split) for r in rows} == {r.uid: (r.fold, r.gold_split) for r in again}
    assert contracts.group_integrity(made["folds"]).count() == 0
    counts = {r.target: (r.pos, r.neg) for r in made["gold_counts"].collect()}
    assert counts["Baker's"] == (4, 4) and len(counts) == 12
    ev = made["folds"].where("gold_split = 'eval'").select("uid")
    with pytest.raises(contracts.ContractError):
        contracts.require(contracts.eval_in_training(ev, made["folds"]), "training list")


def four_rows(spark):
    return spark.createDataFrame(
        [("g-eval", 0, True, "eval", "g-eval"), ("g-train", 1, True, "train_image_ok", "dup"), ("dup-weak", 1, False, "weak", "dup"),
         ("w", 2, False, "weak", "w")], "uid string, fold int, is_gold boolean, gold_split string, group_id string")


def test_all_gold_holdout(spark):
    out = fold_plans.all_gold_holdout(four_rows(spark))
    assert [r.uid for r in out["trainable"].collect()] == ["w"]
    sets = {r.gold_set: r["count"] for r in out["folds"].groupBy("gold_set").count().collect()}
    assert sets == {"A_historic_eval": 1, "B_former_train": 1, "": 2}
    fold1 = out["per_fold"].where("fold = 1").first()
    assert (fold1.trainable, fold1.gold, fold1.dropped_group_member) == (0, 1, 1)


def test_outer_roles(spark):
    f = spark.createDataFrame([(f"u{i}", i % 5, i < 3, "eval" if i < 3 else "weak", f"u{i}") for i in range(20)],
                              "uid string, fold int, is_gold boolean, gold_split string, group_id string")
    roles = {o: {} for o in ("1", "none")}
    for o in roles:
        for r in folds.outer_roles(f, o).collect():
            roles[o].setdefault(r.role, set()).add(r.uid)
    assert roles["1"]["weak"] == {"u6", "u11", "u16"} and roles["1"]["gold"] == {"u0", "u1", "u2"} and len(roles["1"]["train"]) == 14
    assert "weak" not in roles["none"] and len(roles["none"]["train"]) == 17
    assert contracts.split_overlap(folds.outer_roles(f, "1"), f).count() == 0
    only = f.where("fold = 1")
    assert {r.role for r in folds.outer_roles(only.where("gold_split = 'weak'"), "1").collect()} == {"train"}


def test_soft_pool_and_bad_rows(spark):
    f = spark.createDataFrame(
        [("gold", 2, True, "eval", "g"), ("sibling", 2, False, "weak", "g"), ("outer", 0, False, "weak", "o"), ("new", 1, False, "weak", "n"),
         ("masked", 1, False, "weak", "m")], "uid string, fold int, is_gold boolean, gold_split string, group_id string")
    soft = spark.createDataFrame([(u, "ACL", p) for u, p in (("gold", .5), ("sibling", .5), ("outer", .5), ("new", .5), ("masked", None))],
                                 "uid string, target string, p double")
    assert [r.uid for r in folds.soft_training_pool(f, soft, "0").collect()] == ["new"]
    assert sorted(r.uid for r in folds.soft_training_pool(f, soft, "none").collect()) == ["new", "outer"]
    values = spark.createDataFrame([(None,), (-1.0,), (0.3,), (float("nan"),), (float("inf"),), (-2.0,), (1.01,)], "v double")
    got = [(r.p, r.e) for r in values.select(P.soft_target(F.col("v")).alias("p"), P.soft_target_error(F.col("v")).alias("e")).collect()]
    assert got == [(None, False), (None, False), (0.3, False), (None, True), (None, True), (None, True), (None, True)]
    rows = spark.createDataFrame([("a", {"ACL": .2}, None), ("a", {"ACL": .2}, None), ("b", {"XYZ": .2}, None), ("c", {"ACL": 1.5}, None),
                                  ("d", {"ACL": .5}, {"ACL": -1.0}), ("", {"ACL": .5}, None)],
                                 "uid string, soft_targets map<string,double>, target_weights map<string,double>")
    bad = {(r.uid, r.check) for r in softlabels.soft_rows_violations(rows, ["ACL"]).collect()}
    assert bad == {("a", "duplicate_uid"), ("b", "unknown_target"), ("c", "not_a_probability"), ("d", "bad_weight"), ("", "malformed_row")}


def test_canonical_labels_with_gold(spark):
    def env(uid, inner, status="ok", state="criterion_positive"):
        return json.dumps({"uid": uid, "status": status, "payload": {"StudyInstanceUID": inner, "targets": {"ACL": {"state": state}}}})

    lines = spark.createDataFrame([(env("a", "a"),), (env("b", "c"),), (env("q", "q", "quarantine"),), ('{"uid": "n", "y": {"ACL": 1}, "y_weight": {"ACL": 2.0}}',), ("",)], "line string")
    rows = readers.json_text(lines, "line", schemas.ENVELOPE)
    for raw, want in (("-1", (None, 0.0, 0.0, "gold")), ("1", (1.0, 1.0, 1.0, "gold")), ("", (1.0, 1.0, 0.25, "weak"))):
        gold = spark.createDataFrame([("a", raw)], "uid string, ACL string")
        out = label_plans.canonical_labels(rows, gold, ["ACL"])
        cells = {r.uid: (r.y, r["mask"], r.weight, r.source) for r in out["cells"].collect()}
        assert cells["a"] == want and cells["n"] == (1.0, 1.0, 2.0, "weak") and set(cells) == {"a", "n"}
        assert {r.reason: r.n for r in out["rejected"].collect()} == {"uid_mismatch": 1, "status:quarantine": 1}


def test_gold_values(spark):
    df = spark.createDataFrame([(v,) for v in ("0", "1", "1.0", "-1", "", "nan", "x", "2", None, " 1 ")], "v string")
    got = [r.y for r in df.select(P.gold_label(F.col("v"))["y"].alias("y")).collect()]
    assert got == [0.0, 1.0, 1.0, None, None, None, None, None, None, 1.0]


def test_span_recovery(spark):
    rows = [("the ACL  is\ntorn today", "ACL is torn"), ("torn ACL torn  ACL", "torn\tACL"), ("torn ACL. torn  ACL", "torn\nACL"), ("The acl is torn", "ACL is  torn"),
            ("ACL is torn, yes", "ACL is  torn yes"), ("a (b+c)  d", "(b+c) d"), ("abc", "abc"), ("abc", "")]
    got = spark.createDataFrame(rows, "report string, span string").select(text.recover_span(F.col("span"), F.col("report")).alias("x")).collect()
    assert [(r.x.span, r.x.repaired) for r in got] == [
        ("ACL  is\ntorn", True), ("torn\tACL", False), ("torn\nACL", False), ("ACL is  torn", False), ("ACL is  torn yes", False), ("(b+c)  d", True), ("abc", False), ("", False)]


def test_message_choice_and_json(spark):
    rows = [("{\"a\":1}", None, None, True, ("content", None)), ("", "{\"a\":1}", "stop", True, ("reasoning_content", None)),
            ("", "{\"a\":1}", "stop", False, (None, "empty_content")), ("", "so {\"a\":1}", None, True, (None, "reasoning_not_json_object")),
            ("{\"a\":1}", None, "length", True, (None, "truncated_response")), ("{}", None, None, True, (None, "empty_or_non_object")),
            ("{\"a\":1}}", None, None, True, (None, "invalid_json")), ("{\"a\":1}]", None, None, True, (None, "invalid_json")), ("{\"a\":1},{\"b\":2}", None, None, True, (None, "invalid_json"))]
    df = spark.createDataFrame([r[:4] for r in rows], "c string, r string, f string, allow boolean")
    got = df.select(text.select_message(F.col("c"), F.col("r"), F.col("f"), F.col("allow")).alias("x")).collect()
    assert [(r.x.field, r.x.reason) for r in got] == [r[4] for r in rows]
    fenced = spark.createDataFrame([("```json\n{\"a\": 1}\n```",), ("{",), ("{}",)], "c string").select(text.parse_json_content(F.col("c")).alias("x")).collect()
    assert [(r.x.text, r.x.error) for r in fenced] == [('{"a": 1}', None), ("{", "invalid_json"), ("{}", "empty_or_non_object")]


def test_report_chunks(spark):
    df = spark.createDataFrame([("aa\n\nbb\n\ncc", 6), ("aa\n\nbb\n\ncc", 100), ("aaaaaaa\n\nbb", 6), ("", 6), ("aa\n\nbb\n\n\n\ncc", 6)], "t string, n int")
    got = [r.c for r in df.select(text.split_report(F.col("t"), F.col("n")).alias("c")).collect()]
    assert got[:4] == [["aa\n\nbb", "cc"], ["aa\n\nbb\n\ncc"], None, [""]]
    assert got[4] == ["aa\n\nbb", "cc"] or "".join(got[4]).replace("\n", "") == "aabbcc"


def test_cohort_and_breaker(spark):
    f = spark.createDataFrame(
        [("gold", 0, True, "eval", "g"), ("gold-dup", 0, False, "weak", "g"), ("gold-train", 1, True, "train_image_ok", "t"),
         *[(f"dev-{i}", 1, False, "weak", f"d{i}") for i in range(4)]], "uid string, fold int, is_gold boolean, gold_split string, group_id string")
    cohort = selection.development_cohort(f.select("uid"), f)
    none = f.select("uid").where("false")
    assert [r.uid for r in selection.new_attempts(cohort, none, 2).collect()] == ["dev-0", "dev-1"]
    tries = spark.createDataFrame([("r", i, i >= 7) for i in range(30)], "run string, attempt int, rejected boolean")
    stop = extraction.failure_breaker(tries, ["run"], "attempt", "rejected").first()
    assert (stop.stopped_at, stop.attempted, stop.rejected) == (9, 10, 3)


def test_joint_weights(spark):
    rows = [(f"a{i}", 0.0, 0.0, 1.0, 1.0) for i in range(9)] + [("b", 1.0, 1.0, 1.0, 1.0), ("c", 0.0, 1.0, 0.0, 1.0)]
    df = spark.createDataFrame(rows, "uid string, y0 double, y1 double, m0 double, m1 double")
    c = calibration.joint_counts(df).first()
    assert (c.n00, c.n01, c.n10, c.n11) == (9, 0, 0, 1)
    w = {r.uid: r.weight for r in calibration.conditional_weights(df).collect()}
    assert w["c"] == 1 and w["b"] / w["a0"] == pytest.approx(3)
    assert sum(v for k, v in w.items() if k != "c") / 10 == pytest.approx(1)
    many = spark.createDataFrame([(f"a{i}", 0.0, 0.0, 1.0, 1.0) for i in range(100)] + [("b", 1.0, 1.0, 1.0, 1.0)],
                                 "uid string, y0 double, y1 double, m0 double, m1 double")
    assert max(r.weight for r in calibration.conditional_weights(many).collect()) == 3


def test_extraction_batch(spark):
    def finding(span, state="criterion_positive"):
        return {"state": state, "evidence_span": span, "criterion_mapping": "x"}

    reports = spark.createDataFrame([("a", "ACL  torn here"), ("b", "fine"), ("c", "fine too"), ("e", "x" * 5000)], "uid string, report string")
    none = spark.createDataFrame([], "resume_key string, status string")
    pending = label_plans.pending_reports(reports, none, model="m", revision="", prompt_hash="p", ontology="o", evidence_policy="e",
                                          context_tokens=1000, output_tokens=300)
    ok = {"StudyInstanceUID": "a", "targets": {"ACL": finding("ACL torn")}}
    bad = {"StudyInstanceUID": "b", "targets": {"ACL": finding("gone")}}
    replies = spark.createDataFrame([("a", 0, json.dumps(ok), None, "stop"), ("b", 0, json.dumps(bad), None, None), ("e", 0, json.dumps(ok), None, None)],
                                    "uid string, chunk int, content string, reasoning_content string, finish_reason string")
    got = {r.uid: r for r in label_plans.extraction_batch(pending, replies, ["ACL"]).collect()}
    assert got["a"].status == "ok" and got["a"].repaired == ["ACL"] and got["a"].targets["ACL"].evidence_span == "ACL  torn"
    assert got["b"].reason == "ACL:evidence_not_in_report" and got["c"].reason == "no_reply" and got["e"].reason == "report_exceeds_context"
    done = spark.createDataFrame([(got["a"].resume_key, "ok")], "resume_key string, status string")
    again = label_plans.pending_reports(reports, done, model="m", revision="", prompt_hash="p", ontology="o", evidence_policy="e",
                                        context_tokens=1000, output_tokens=300)
    assert sorted(r.uid for r in again.collect()) == ["b", "c", "e"]


def test_state_labels_keep_minus_one_out(spark):
    df = spark.createDataFrame([(s,) for s in (*P.STATES, None, "odd")], "s string")
    got = {r.s: (r.l.y, r.l["mask"], r.l.weight) for r in df.select("s", P.state_label(F.col("s")).alias("l")).collect()}
    assert got["criterion_positive"] == (1.0, 1.0, 0.25) and got["borderline_negative_hint"] == (0.0, 1.0, 0.15)
    assert all(got[s] == (None, 0.0, 0.0) for s in ("uncertain", "not_mentioned", None, "odd"))
    assert labels.label_table_violations(spark.createDataFrame([("u", "t", -1.0, 1.0)], "uid string, target string, y double, mask double")).count() == 1


def dealt(spark, sizes, n_folds=5, gold=()):
    """Rows per fold and gold rows per fold of groups of these sizes; gold: index of the group -> its gold rows."""
    gold = dict(gold)
    rows = [(f"u{g}-{i}", f"g{g}", i < gold.get(g, 0)) for g, n in enumerate(sizes) for i in range(n)]
    units = spark.createDataFrame(rows, "uid string, group_id string, is_gold boolean")
    found = folds.deal_folds(units.repartition(3), n_folds, 7).collect()
    assert sorted(r.group_id for r in found) == sorted(f"g{g}" for g in range(len(sizes))) and {r.fold for r in found} <= set(range(n_folds))
    at = {r.group_id: r.fold for r in found}
    return [sum(n for g, n in enumerate(sizes) if at[f"g{g}"] == f) for f in range(n_folds)], [sum(gold.get(g, 0) for g in range(len(sizes)) if at[f"g{g}"] == f) for f in range(n_folds)]


def test_a_dominating_group_leaves_the_other_folds_even(spark):
    sizes = [400] + [1 + (7 * i) % 5 for i in range(260)]
    rows, _ = dealt(spark, sizes)
    rest = sorted(rows)
    assert max(rest) == 400 and max(rest[:4]) - min(rest[:4]) <= 5  # an even fifth would be 236
    # with gold in the large group: its rows count where the others are placed, and gold is even for itself
    rows, gold = dealt(spark, sizes, gold={0: 1, **{i: 1 for i in range(1, 41)}})
    rest = sorted(rows)
    assert sorted(gold) == [8, 8, 8, 8, 9] and max(rest) <= 400 + 40 and max(rest[:4]) - min(rest[:4]) <= 5
    # two large groups, and groups of one size
    rows, _ = dealt(spark, [300, 300] + [1] * 100)
    assert sorted(rows) == [33, 33, 34, 300, 300]
    assert sorted(dealt(spark, [2] * 50)[0]) == [20] * 5 and sorted(dealt(spark, [5])[0]) == [0, 0, 0, 0, 5]


def test_an_empty_or_invalid_soft_pool_is_an_error(spark):
    table = spark.createDataFrame([("a", 0, "weak", "a"), ("b", 1, "weak", "b"), ("c", 1, "eval", "c")], "uid string, fold int, gold_split string, group_id string")
    soft = lambda rows: spark.createDataFrame(rows, "uid string, target string, p double")
    assert [r.uid for r in folds.soft_training_pool(table, soft([("a", "t", 0.5), ("b", "t", None)]), "1", strict=True).collect()] == ["a"]
    assert folds.soft_training_pool(table, soft([("b", "t", 0.5)]), "1").count() == 0
    for rows in ([("b", "t", 0.5)], [("a", "t", 1.5)], [("a", "t", 0.5), ("a", "t", 0.5)], [("a", "t", None)]):
        with pytest.raises(contracts.ContractError):
            folds.soft_training_pool(table, soft(rows), "1", strict=True)
    with pytest.raises(contracts.ContractError):
        folds.soft_training_pool(table.union(spark.createDataFrame([("d", 2, "weak", "a")], table.schema)), soft([("a", "t", 0.5)]), "1", strict=True)
