"""Checking, repairing and merging extractor replies against their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.predicates import STATES
from tallyfold.functions.text import evidence_error, recover_span
from tallyfold.scale import col, cols, prefix_sums

REQUIRED_FIELDS = ("state", "evidence_span", "criterion_mapping")


def validation_errors(uid_found: Column, uid_expected: Column, targets: Column, report: Column,
                      names: Sequence[str]) -> Column:
    """Array of error texts for one payload; empty when it is acceptable.

    ``targets`` is a map target -> finding struct. An id mismatch hides every other error.
    """
    wanted = F.array(*[F.lit(n) for n in names])
    keys = F.coalesce(F.map_keys(targets), F.array().cast("array<string>"))
    missing, extra = F.array_except(wanted, keys), F.array_except(keys, wanted)
    entries = F.coalesce(F.map_entries(targets), F.array())

    def one(e: Column) -> Column:
        name, rec = e["key"], e["value"]
        fields = [
            F.when(rec[f].isNull(), F.concat(name, F.lit(f":missing_field:{f}"))) for f in REQUIRED_FIELDS]
        bad_state = F.when(rec["state"].isNotNull() & ~rec["state"].isin(*STATES),
                           F.concat(name, F.lit(":bad_state:"), rec["state"]))
        evidence = F.concat(name, F.lit(":"), evidence_error(rec["state"], rec["evidence_span"], report))
        return F.array(*fields, bad_state, evidence)

    listed = F.array(
        F.when(F.size(missing) > 0, F.concat(F.lit("missing_targets:"), F.array_join(F.sort_array(missing), ","))),
        F.when(F.size(extra) > 0, F.concat(F.lit("unknown_targets:"), F.array_join(F.sort_array(extra), ","))))
    errors = F.array_compact(F.concat(listed, F.flatten(F.transform(entries, one))))
    clash = F.coalesce(uid_found != uid_expected, F.lit(False))
    return F.when(clash, F.array(F.lit("uid_mismatch"))).otherwise(F.sort_array(errors))


def recover_spans(rows: DataFrame, targets: str = "targets", report: str = "report") -> DataFrame:
    """Replace whitespace-only span differences by the source text; list the repaired targets.

    Works on long rows (…, target, span) or on a map column through ``explode`` upstream.
    """
    fixed = rows.withColumn("__r", recover_span(col(targets), col(report)))
    return fixed.withColumn("span", F.col("__r.span")).withColumn("repaired", F.col("__r.repaired")).drop("__r")


def repair_findings(findings: DataFrame) -> DataFrame:
    """(uid, report, targets map) -> targets with recovered spans and the list of repaired target names."""
    def fix(k: Column, rec: Column) -> Column:
        return rec.withField("evidence_span", recover_span(rec["evidence_span"], F.col("report"))["span"])

    before = F.col("targets")
    after = F.transform_values("targets", fix)
    out = findings.withColumn("__before", before).withColumn("targets", after)
    changed = F.filter(F.map_keys("targets"), lambda k: ~F.try_element_at("targets", k)["evidence_span"].eqNullSafe(
        F.try_element_at("__before", k)["evidence_span"]))
    return out.withColumn("repaired", F.sort_array(changed)).drop("__before")


def first_decisive(chunks: DataFrame, ids: Sequence[str] = ("uid",)) -> DataFrame:
    """Per (id, target) the finding of the earliest chunk that says something; else not_mentioned.

    ``chunks`` is (ids, chunk, target, state, span); ``min_by`` combines map-side.
    """
    decisive = ~F.coalesce(F.col("state"), F.lit("")).isin("", "not_mentioned")
    pick = F.min_by(F.struct("state", "span"), F.when(decisive, F.col("chunk")))
    return chunks.groupBy(*cols(ids), "target").agg(pick.alias("b"), F.bool_or(decisive).alias("d")).select(
        *cols(ids), "target",
        F.when(F.col("d"), F.col("b.state")).otherwise(F.lit("not_mentioned")).alias("state"),
        F.when(F.col("d"), F.col("b.span")).otherwise(F.lit("")).alias("span"))


def failure_breaker(attempts: DataFrame, run: Sequence[str], order: str, rejected: str, *, minimum: int = 10,
                    limit: float = 0.2) -> DataFrame:
    """First attempt of each run at which enough attempts were made and too many were rejected."""
    rows = attempts.withColumn("__a", F.lit(1).cast("long")).withColumn("__r", col(rejected).cast("int").cast("long"))
    run_sums = prefix_sums(rows, run, [col(order)], ["__a", "__r"])
    seen, bad = F.col("__a_before") + 1, F.col("__r_before") + F.col("__r")
    hit = (seen >= minimum) & (bad / seen > limit)
    return run_sums.where(hit).groupBy(*cols(run)).agg(
        F.min(col(order)).alias("stopped_at"), F.min_by(seen, col(order)).alias("attempted"),
        F.min_by(bad, col(order)).alias("rejected"))


def label_quality(raw: DataFrame, allowed: DataFrame, reports: DataFrame, names: Sequence[str]) -> DataFrame:
    """Tag every raw extraction: quarantined, outside the selection or repeated, evidence error, or valid.

    ``raw`` is (seq, uid, status, targets map). The first row of an id by ``seq`` is the one judged.
    """
    ok = F.coalesce(F.col("status") == "ok", F.lit(False))
    first = raw.where(ok).groupBy("uid").agg(F.min("seq").alias("__first"))
    tagged = (
        raw.join(allowed.select("uid", F.lit(True).alias("__allowed")), "uid", "left")
        .join(first, "uid", "left")
        .join(reports.select("uid", F.coalesce("report", F.lit("")).alias("report")), "uid", "left")
        .withColumn("report", F.coalesce("report", F.lit("")))
    )
    errors = validation_errors(F.col("uid"), F.col("uid"), F.col("targets"), F.col("report"), names)
    reason = (
        F.when(~ok, F.lit("quarantined"))
        .when(F.col("__allowed").isNull() | (F.col("seq") != F.col("__first")), F.lit("selection_or_duplicate_error"))
        .when(F.size(errors) > 0, F.lit("strict_evidence_or_schema_error"))
        .otherwise(F.lit("valid"))
    )
    return tagged.withColumn("reason", reason).drop("__allowed", "__first", "report")


def quality_report(tagged: DataFrame, minimum: int) -> DataFrame:
    """One row with counts per reason, the error rate and the pass flag."""
    def count(reason: str) -> Column:
        return F.count_if(F.col("reason") == reason)

    out = tagged.agg(
        F.count(F.lit(1)).alias("attempted"), count("valid").alias("valid"), count("quarantined").alias("quarantined"),
        count("selection_or_duplicate_error").alias("selection_errors"),
        count("strict_evidence_or_schema_error").alias("evidence_errors"))
    rate = (F.col("attempted") - F.col("valid")) / F.greatest(F.lit(1), F.col("attempted"))
    out = out.withColumn("error_rate", rate)
    return out.withColumn("passed", (F.col("valid") >= minimum) & (F.col("error_rate") <= 0.05)
                          & (F.col("selection_errors") == 0))


def state_counts(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("reason") == "valid").select(F.explode("targets").alias("target", "f")).groupBy(
        "target", F.col("f.state").alias("state")).agg(F.count(F.lit(1)).alias("n"))


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key; a grouped ``max_by`` keeps one row per key before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    rank = F.struct(*cols(order))
    return rows.groupBy(*cols(keys)).agg(F.max_by(F.struct(*cols(rest)), rank).alias("__r")).select(
        *cols(keys), *[F.col("__r").getField(c).alias(c) for c in rest])


def first_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
               name: str | None = None) -> DataFrame:
    """First k rows per key; Spark applies the limit before the shuffle as well."""
    w = Window.partitionBy(*cols(keys)).orderBy(*order)
    at = name or "__k"
    top = rows.withColumn(at, F.row_number().over(w)).where(F.col(at) <= k)
    return top if name else top.drop(at)
