"""Label jobs: canonical labels, soft and pseudo label tables, extraction batches, audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.hashing import resume_key
from tallyfold.functions.predicates import all_nonempty, nonempty
from tallyfold.functions.text import context_chars, select_message, split_report, unfence
from tallyfold.operators import agreement, contracts, extraction, labels, selection, softlabels
from tallyfold.schemas import EXTRACTION
from tallyfold.scale import attach, col
from tallyfold.sources.writers import provenance


def canonical_labels(envelopes: DataFrame, gold: DataFrame, targets: Sequence[str]) -> dict[str, DataFrame]:
    """Envelopes to canonical cells with trusted labels on top, rejects and a one-row report."""
    tagged = labels.tag_envelopes(envelopes)
    cells = labels.canonical_cells(tagged, gold, targets)
    return {"cells": cells, "rejected": labels.reject_reasons(tagged), "report": labels.publish_report(tagged, cells)}


def numeric_training_labels(envelopes: DataFrame, train: DataFrame, targets: Sequence[str], *, strict: bool = True) -> DataFrame:
    tagged = labels.tag_envelopes(envelopes)
    if strict:
        contracts.require(labels.numeric_label_violations(tagged), "numeric training labels")
    return labels.numeric_training_cells(tagged, train, targets)


def soft_mean_labels(sources: DataFrame, folds: DataFrame, name: str = "soft-mean") -> dict[str, DataFrame]:
    cells = softlabels.equal_source_mean(sources, folds)
    return {"cells": cells, "provenance": provenance(
        cells, ["uid", "target", "p"], {"sources": (sources, ["source", "uid", "target", "p"])}, name,
        "equal mean of every source; gold excluded")}


def available_mean_labels(sources: DataFrame, gold: DataFrame, targets: Sequence[str], name: str = "available-mean") -> dict[str, DataFrame]:
    cells = softlabels.available_source_mean(sources, gold, targets)
    return {"cells": cells, "report": softlabels.masked_cells(cells), "provenance": provenance(
        cells, ["uid", "target", "p"], {"sources": (sources, ["source", "uid", "target", "p"])}, name,
        "mean of available sources, clipped; gold excluded")}


def pseudo_labels(predictions: DataFrame, teachers: DataFrame, training: DataFrame, base: DataFrame, folds: DataFrame, *,
                  alpha: float, blind_to: str | None = None, strict: bool = True) -> dict[str, DataFrame]:
    """Teacher predictions on their held-out folds mixed with a base table.

    ``predictions`` is (teacher, uid, target, p). Leakage rules are checked first. ``provenance`` has each teacher's held-out and
    excluded folds and number of ids, ``report`` one row: ids, those without a base label, folds covered and cells from the base.
    """
    bad = softlabels.pseudo_label_violations(teachers, predictions, training, folds, blind_to)
    if strict:
        contracts.require(bad, "pseudo labels")
    per_teacher = predictions.groupBy("teacher").agg(F.count_distinct("uid").alias("n_rows"))
    provenance = teachers.join(per_teacher, "teacher", "left").select(
        "teacher", F.col("fold").alias("held_out_fold"), F.col("excluded").alias("excluded_folds"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    ids = predictions.groupBy("uid").agg(F.min("teacher").alias("teacher"))
    marked = ids.join(base.select("uid").distinct().withColumn("__base", F.lit(True)), "uid", "left").join(teachers.select("teacher", "fold"), "teacher")
    cells = predictions.select("uid", "target").join(base.where(F.col("p").isNotNull()).select("uid", "target"), ["uid", "target"], "left_semi")
    report = attach(marked.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("__base").isNull()).alias("rows_without_base"),
        F.array_sort(F.collect_set("fold")).alias("folds_covered")), cells.agg(F.count(F.lit(1)).alias("cells_with_base")))
    return {"cells": softlabels.teacher_base_mix(predictions, base, alpha), "violations": bad, "provenance": provenance, "report": report}


def audit_sources(states: DataFrame, sources: DataFrame, gold: DataFrame, reference: str) -> dict[str, DataFrame]:
    """Agreement report: every source against gold, our states against gold and against the sources.

    ``states`` is (uid, target, state), ``sources`` (source, uid, target, p), ``gold`` (uid, target, y).
    """
    gold_ids = gold.select("uid").distinct()
    weak_states = states.join(gold_ids, "uid", "left_anti")
    weak_sources = sources.join(gold_ids, "uid", "left_anti")
    common = weak_sources.join(selection.common_ids(sources), "uid", "left_semi")
    return {
        "vs_gold": agreement.source_vs_gold(sources, gold),
        "policies": agreement.policy_vs_gold(states, gold, labels.POLICIES),
        "positive_rate": agreement.state_positive_rate(states, gold),
        "profile": agreement.state_score_profile(weak_states, weak_sources),
        "explicit_auc": agreement.explicit_state_auc(weak_states, weak_sources),
        "disagreements": agreement.disagreement_counts(
            agreement.disagreements(weak_states, weak_sources.where(F.col("source") == reference))),
        "pearson": agreement.pairwise_pearson(common),
    }


def pending_reports(reports: DataFrame, done: DataFrame, *, model: str, revision: str, prompt_hash: str, ontology: str,
                    evidence_policy: str, context_tokens: int, output_tokens: int) -> DataFrame:
    """(uid, report, resume_key, chunks): reports without a finished result under the same key.

    A report with a paragraph that alone exceeds the context has null chunks and is quarantined.
    """
    key = resume_key(F.col("uid"), F.col("report"), F.lit(model), F.lit(revision), F.lit(prompt_hash), F.lit(ontology),
                     F.lit(evidence_policy))
    keyed = reports.select("uid", "report", key.alias("resume_key"))
    finished = done.where(F.col("status") == "ok").select("resume_key")
    size = context_chars(F.lit(context_tokens), F.lit(output_tokens))
    return keyed.join(finished, "resume_key", "left_anti").withColumn("chunks", split_report(F.col("report"), size))


def extraction_batch(pending: DataFrame, replies: DataFrame, names: Sequence[str], *, allow_reasoning: bool = False) -> DataFrame:
    """Judge model replies: (uid, resume_key, status, reason, targets map).

    ``pending`` comes from ``pending_reports``; ``replies`` is (uid, chunk, content, reasoning_content,
    finish_reason), one row per chunk. Chunks merge by the first decisive finding per target,
    whitespace-only span differences are repaired, then the payload is validated.
    """
    picked = replies.withColumn("m", select_message(
        F.col("content"), F.col("reasoning_content"), F.col("finish_reason"), F.lit(allow_reasoning)))
    parsed = picked.withColumn("x", F.from_json(unfence(F.col("m.raw")), EXTRACTION))
    per = parsed.groupBy("uid").agg(
        F.min_by("m.reason", F.when(F.col("m.reason").isNotNull(), F.col("chunk"))).alias("bad"),
        F.count_distinct("chunk").alias("n_chunks"), F.min("x.StudyInstanceUID").alias("uid_found"))
    single = parsed.select("uid", "chunk", F.explode("x.targets").alias("target", "f"))
    decisive = ~F.coalesce(F.col("f.state"), F.lit("")).isin("", "not_mentioned")
    first = single.groupBy("uid", "target").agg(
        F.coalesce(F.min_by("f", F.when(decisive, F.col("chunk"))), F.min_by("f", "chunk")).alias("f"))
    merged = first.groupBy("uid").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("target", "f")))).alias("targets"))
    rows = (pending.select("uid", "resume_key", "report", F.size("chunks").alias("want"), F.col("chunks").isNull().alias("oversize"))
            .join(per, "uid", "left").join(merged, "uid", "left"))
    repaired = extraction.repair_findings(rows.withColumn("targets", F.coalesce(
        "targets", F.create_map().cast("map<string," + EXTRACTION["targets"].dataType.valueType.simpleString() + ">"))))
    errors = extraction.validation_errors(F.coalesce("uid_found", "uid"), F.col("uid"), F.col("targets"), F.col("report"), names)
    reason = (
        F.when(F.col("oversize"), F.lit("report_exceeds_context"))
        .when(F.col("n_chunks").isNull(), F.lit("no_reply"))
        .when(F.col("bad").isNotNull(), F.col("bad"))
        .when(F.size("errors") > 0, F.array_join("errors", ";")))
    out = repaired.withColumn("errors", errors).withColumn("reason", reason)
    return out.select("uid", "resume_key", F.when(F.col("reason").isNull(), F.lit("ok")).otherwise(F.lit("quarantine")).alias("status"),
                      "reason", "repaired", "targets")


def metadata_audit(train: DataFrame, series: DataFrame, targets: Sequence[str], sample_columns: Sequence[str], test: DataFrame,
                   report: str = "report") -> dict[str, DataFrame]:
    """Counts of the study and series tables and value counts of the series flags."""
    base = train.agg(
        F.count(F.lit(1)).alias("n_train"), F.count_distinct("uid").alias("n_unique_uid"),
        F.count_if(all_nonempty(targets)).alias("n_gold"), F.count_if(~nonempty(col(report))).alias("n_missing_report"))
    ser = series.agg(
        F.count(F.lit(1)).alias("n_series"), F.count_distinct("study").alias("n_series_studies"),
        F.count_if(F.col("fluid").eqNullSafe(F.col("fat"))).alias("n_flags_equal"))
    out = attach(attach(base, ser), test.agg(F.count(F.lit(1)).alias("n_test")))
    out = out.withColumn("flags_all_equal", (F.col("n_series") > 0) & (F.col("n_series") == F.col("n_flags_equal"))).withColumn(
        "columns_match", F.lit(list(sample_columns)[1:] == list(targets)))
    return {"summary": out, "values": agreement.value_counts(series, ["plane", "fluid", "fat"])}


def export_numeric(cells: DataFrame) -> DataFrame:
    return contracts.numeric_export(cells, [c for c in cells.columns if c in {
        "uid", "source", "target", "y", "mask", "weight", "ontology_version"}])


