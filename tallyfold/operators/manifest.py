"""Cache manifests: coverage, budgets, size profiles, part merging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.scale import attach, col, cols, exact_quantiles, join_on, prefix_sums


def slot_details(manifest: DataFrame) -> DataFrame:
    """One row per (uid, slot) of the nested series details."""
    return manifest.select("uid", F.posexplode("series_details").alias("slot", "d")).select("uid", "slot", "d.*")


def slot_coverage(details: DataFrame) -> DataFrame:
    """Per slot: present, missing, fallback, slice totals, duplicate centers and the median spacing."""
    base = details.groupBy("slot").agg(
        F.count_if("present").alias("present"), F.count_if(~F.col("present")).alias("missing"),
        F.count_if(F.col("fallback") & F.col("present")).alias("fallback"),
        F.coalesce(F.sum("n_decoded_slices"), F.lit(0)).alias("decoded_slices"),
        F.coalesce(F.sum("n_slices"), F.lit(0)).alias("available_slices"),
        F.coalesce(F.sum("duplicate_centers"), F.lit(0)).alias("duplicate_centers"))
    spacing = exact_quantiles(details, ["slot"], "slice_spacing_mm_median", {"slice_spacing_mm_median": 0.5})
    return base.join(spacing, "slot", "left")


def missing_reasons(details: DataFrame) -> DataFrame:
    return details.where(~F.col("present")).groupBy("slot", F.coalesce("error", F.lit("unknown")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"))


def order_modes(details: DataFrame) -> DataFrame:
    return details.where(F.col("order").isNotNull()).groupBy("order").agg(F.count(F.lit(1)).alias("n"))


def present_planes(manifest: DataFrame) -> DataFrame:
    """(present, n): studies by how many slots they fill."""
    filled = F.aggregate("slot_mask", F.lit(0), lambda acc, v: acc + v.cast("int"))
    return manifest.groupBy(filled.alias("present")).agg(F.count(F.lit(1)).alias("n"))


def reason_counts(rows: DataFrame, reason: str = "reason") -> DataFrame:
    return rows.groupBy(col(reason)).agg(F.count(F.lit(1)).alias("n"))


def admit_under_budget(requests: DataFrame, existing: DataFrame, limit: int, order: str) -> DataFrame:
    """Admit requests in order until one would pass the limit; later ones are not attempted.

    ``requests`` is (order, uid, bytes), ``existing`` (uid, bytes). A request that replaces
    stored bytes releases them first.
    """
    prior = existing.select("uid", F.col("bytes").alias("__prior"))
    rows = requests.join(prior, "uid", "left").withColumn(
        "__delta", F.col("bytes") - F.coalesce("__prior", F.lit(0)))
    running = prefix_sums(rows, [], [col(order)], ["__delta"])
    running = attach(running, existing.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("__stored")))
    running = running.withColumn("projected", F.col("__stored") + F.col("__delta_before") + F.col("__delta"))
    first = running.where(F.col("projected") > limit).agg(F.min(col(order)).alias("__first"))
    out = attach(running, first)
    status = (
        F.when(F.col("__first").isNull() | (col(order) < F.col("__first")), F.lit("admitted"))
        .when(col(order) == F.col("__first"), F.lit("cache_budget_exceeded"))
        .otherwise(F.lit("not_attempted")))
    return out.select(col(order), "uid", "bytes", "projected", status.alias("status"))


def size_profile(rows: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """mean, p50, p95 and max per key; a null key is a key, and a key without values has nulls."""
    keys = list(keys)
    q = exact_quantiles(rows, keys, value, {"p50": 0.5, "p95": 0.95})
    base = rows.groupBy(*cols(keys)).agg(F.avg(col(value)).alias("mean"), F.max(col(value)).alias("max"))
    return join_on(base, q, keys, "left") if keys else attach(base, q)


def project_full(measured: DataFrame, n_full: int, raw_bytes: float) -> DataFrame:
    """Per config: bytes and seconds per study, compression ratio, GiB and hours at full size.

    ``measured`` is (config, bytes, seconds), one row per built study.
    """
    per = measured.groupBy("config").agg(
        F.count(F.lit(1)).alias("n_built"), F.avg("bytes").alias("bytes_per_study"),
        F.avg("seconds").alias("seconds_per_study"))
    return per.select(
        "config", "n_built", "bytes_per_study", F.round("seconds_per_study", 3).alias("seconds_per_study"),
        F.round(F.lit(float(raw_bytes)) / F.nullif("bytes_per_study", F.lit(0.0)), 3).alias("compression_ratio"),
        F.round(F.col("bytes_per_study") * n_full / F.lit(1024.0 ** 3), 2).alias("projected_gib"),
        F.round(F.col("seconds_per_study") * n_full / 3600, 2).alias("projected_hours"))


def runtime_gate(measured: DataFrame, n_hidden: int = 1300, minimum: int = 30, limit_seconds: float = 9 * 3600) -> DataFrame:
    """``measured`` is (key, seconds_per_study, n_measured): projected seconds and whether they stay under the limit."""
    enough = F.col("seconds_per_study").isNotNull() & (F.col("n_measured") >= minimum)
    projected = F.when(enough, F.col("seconds_per_study") * n_hidden)
    reason = (F.when(F.col("n_measured") < minimum, F.lit("benchmark_too_small"))
              .when(F.col("seconds_per_study").isNull(), F.lit("no_measurement")).otherwise(F.lit("measured_batch")))
    return measured.withColumn("projected_seconds", projected).withColumn(
        "under_limit", F.coalesce(F.col("projected_seconds") < limit_seconds, F.lit(False))).withColumn("reason", reason)


def training_budget(measured: DataFrame, max_seconds: float, max_fraction: float) -> DataFrame:
    """(studies, seconds, total_studies, peak_bytes, device_bytes) -> throughput, projection and reasons."""
    rate = F.try_divide(F.col("studies"), F.col("seconds"))
    out = measured.withColumn("studies_per_second", rate).withColumn(
        "projected_seconds", F.try_divide(F.col("total_studies"), F.col("studies_per_second"))).withColumn(
        "peak_fraction", F.try_divide(F.col("peak_bytes"), F.col("device_bytes")))
    invalid = F.exists(F.array(*[F.col(c).cast("double") for c in ("studies", "seconds", "total_studies", "device_bytes")]),
                       lambda v: F.coalesce(v <= 0, F.lit(True))) | F.coalesce(F.col("peak_bytes") < 0, F.lit(True))
    reasons = F.array_compact(F.array(
        F.when(invalid, F.lit("invalid_measurement")),
        F.when(F.col("projected_seconds") > max_seconds, F.lit("projected_training_time_exceeded")),
        F.when(F.col("peak_fraction") > max_fraction, F.lit("peak_vram_fraction_exceeded"))))
    return out.withColumn("reasons", reasons).withColumn("passed", F.size("reasons") == 0)


def progress_report(events: DataFrame, keys: Sequence[str], total: str = "total") -> DataFrame:
    """Latest progress per key: (done, total, elapsed_seconds) -> studies per minute and eta."""
    last = events.groupBy(*cols(keys)).agg(
        F.max("done").alias("done"), F.max_by(col(total), F.col("done")).alias("total"),
        F.max_by(F.col("elapsed_seconds"), F.col("done")).alias("elapsed_seconds"))
    rate = F.col("done") / F.greatest(F.col("elapsed_seconds"), F.lit(1e-6))
    return last.withColumn("per_minute", F.round(rate * 60, 2)).withColumn(
        "eta_seconds", F.round(F.try_divide(F.col("total") - F.col("done"), rate), 1))


def merge_violations(parts: DataFrame, requested: DataFrame) -> DataFrame:
    """Why manifests cannot be merged: policies differ, a part hit its budget, or requested ids overlap.

    ``parts`` is (part, policy_hash, budget_error), ``requested`` (part, uid).
    """
    policies = parts.agg(F.count_distinct("policy_hash").alias("n")).where("n > 1").select(
        F.lit("different_policies").alias("check"), F.col("n").cast("string").alias("key"))
    budget = parts.where(F.col("budget_error").isNotNull()).select(
        F.lit("part_stopped_on_budget").alias("check"), F.col("part").cast("string").alias("key"))
    overlap = requested.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.lit("overlapping_parts").alias("check"), F.col("uid").alias("key"))
    return policies.unionByName(budget).unionByName(overlap)


def merge_summary(studies: DataFrame, requested: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row over all parts: studies, requested, quarantined, bytes, and whether the request is complete."""
    s = studies.select("uid", F.lit("s").alias("k"), "bytes")
    r = requested.select("uid", F.lit("r").alias("k"), F.lit(None).cast("long").alias("bytes"))
    q = quarantine.select("uid", F.lit("q").alias("k"), F.lit(None).cast("long").alias("bytes"))
    per = s.unionByName(r).unionByName(q).groupBy("uid").agg(
        F.count_if(F.col("k") == "s").alias("ns"), F.count_if(F.col("k") == "r").alias("nr"),
        F.count_if(F.col("k") == "q").alias("nq"), F.sum("bytes").alias("bytes"))
    return per.agg(
        F.sum("ns").alias("n_studies"), F.sum("nr").alias("n_requested"), F.sum("nq").alias("n_quarantine"),
        F.sum("bytes").alias("byte_total"),
        (F.count_if((F.col("ns") > 0) != (F.col("nr") > 0)) + F.sum("nq") == 0).alias("requested_complete"))


def manifest_violations(header: DataFrame, studies: DataFrame, requested: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Everything that keeps a manifest from being ready, as (manifest, step, check, key); lowest step first.

    ``header`` is (manifest, scope, policy_hash, policy_hash_actual, n_studies, n_requested, byte_total, max_bytes,
    budget_error), ``studies`` (manifest, uid, meta_uid, policy_hash, slot_mask, bytes), ``requested`` and
    ``quarantine`` (manifest, uid).
    """
    from tallyfold.functions.predicates import safe_id

    per = studies.groupBy("manifest").agg(
        F.count(F.lit(1)).alias("__ns"), F.sum("bytes").alias("__bytes"))
    req = requested.groupBy("manifest").agg(F.count(F.lit(1)).alias("__nr"))
    dup = requested.groupBy("manifest", "uid").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    h = header.join(per, "manifest", "left").join(req, "manifest", "left")
    ns, nr = F.coalesce("__ns", F.lit(0)), F.coalesce("__nr", F.lit(0))
    head = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("scope").isin("pilot", "full"), F.lit(False)),
               F.struct(F.lit(1).alias("step"), F.lit("cache_scope_missing").alias("check"))),
        F.when(ns == 0, F.struct(F.lit(2).alias("step"), F.lit("cache_empty").alias("check"))),
        F.when(~F.col("policy_hash").eqNullSafe(F.col("policy_hash_actual")),
               F.struct(F.lit(3).alias("step"), F.lit("manifest_preprocess_mismatch").alias("check"))),
        F.when(~F.col("byte_total").eqNullSafe(F.coalesce("__bytes", F.lit(0))),
               F.struct(F.lit(4).alias("step"), F.lit("manifest_compressed_size_mismatch").alias("check"))),
        F.when((F.coalesce("__bytes", F.lit(0)) > F.coalesce("max_bytes", F.lit(0))) | F.col("budget_error").isNotNull(),
               F.struct(F.lit(5).alias("step"), F.lit("cache_budget_exceeded").alias("check"))),
        F.when(~F.col("n_studies").eqNullSafe(ns), F.struct(F.lit(6).alias("step"), F.lit("study_count_mismatch").alias("check"))),
        F.when(~F.col("n_requested").eqNullSafe(nr), F.struct(F.lit(7).alias("step"), F.lit("request_count_mismatch").alias("check")))))
    out = h.select("manifest", F.explode(head).alias("c"), F.lit("").alias("key")).select("manifest", "c.step", "c.check", "key")

    def rows(df: DataFrame, step: int, check: str) -> DataFrame:
        return df.select("manifest", F.lit(step).alias("step"), F.lit(check).alias("check"), F.col("uid").alias("key"))

    keys = ["manifest", "uid"]
    pol = header.select("manifest", F.col("policy_hash").alias("__p"))
    mask_bad = (
        F.coalesce(F.size("slot_mask") < 1, F.lit(True)) | F.exists("slot_mask", lambda v: ~v.isin(0.0, 1.0))
        | ~F.exists("slot_mask", lambda v: v > 0))
    parts = [
        rows(dup, 7, "request_count_mismatch"),
        rows(studies.select(*keys).join(requested.select(*keys), keys, "left_anti"), 8, "unexpected_study"),
        rows(quarantine, 9, "requested_scope_incomplete"),
        rows(requested.select(*keys).join(studies.select(*keys), keys, "left_anti"), 9, "requested_scope_incomplete"),
        rows(studies.where(~safe_id(F.col("uid")) | ~F.col("meta_uid").eqNullSafe(F.col("uid"))), 10, "invalid_study_uid"),
        rows(studies.withColumnRenamed("policy_hash", "__s").join(pol, "manifest").where(~F.col("__s").eqNullSafe(F.col("__p"))),
             11, "study_policy_mismatch"),
        rows(studies.where(F.coalesce(mask_bad, F.lit(True))), 12, "invalid_slot_mask"),
    ]
    for p in parts:
        out = out.unionByName(p)
    return out


def manifest_ready(header: DataFrame, violations: DataFrame) -> DataFrame:
    """(manifest, ready, reason): the first failing check, or the scope of a ready manifest."""
    first = violations.groupBy("manifest").agg(F.min_by("check", F.struct("step", "check")).alias("reason"))
    return header.select("manifest", "scope").join(first, "manifest", "left").select(
        "manifest", F.col("reason").isNull().alias("ready"), F.coalesce("reason", "scope").alias("reason"))


def file_integrity(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, reason) for every manifest entry or stored file that does not agree.

    ``files`` is (path, size, sha256) as read by the file scan, ``manifest`` the same three as promised.
    """
    f = files.select("path", F.col("size").alias("__fs"), F.col("sha256").alias("__fh"))
    m = manifest.select("path", F.col("size").alias("__ms"), F.col("sha256").alias("__mh"))
    both = m.join(f, "path", "full_outer")
    reason = (
        F.when(F.col("__fh").isNull(), F.lit("missing_file")).when(F.col("__mh").isNull(), F.lit("unexpected_file"))
        .when(F.col("__fs") != F.col("__ms"), F.lit("size_mismatch")).when(F.col("__fh") != F.col("__mh"), F.lit("hash_mismatch")))
    return both.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("path", "reason")


def receipt_violations(receipts: DataFrame, shards: DataFrame) -> DataFrame:
    """Shard receipts against the shard ids they must cover.

    ``receipts`` is (shard, status, n_studies, ids_sha256), ``shards`` (shard, n_ids, ids_sha256) computed from the universe.
    """
    e = shards.select("shard", "n_ids", F.col("ids_sha256").alias("__want"))
    both = e.join(receipts, "shard", "full_outer")
    check: Column = (
        F.when(F.col("status").isNull(), F.lit("receipt_missing")).when(F.col("n_ids").isNull(), F.lit("unknown_shard"))
        .when(F.col("status") != "ok", F.lit("job_not_complete")).when(F.col("n_studies") != F.col("n_ids"), F.lit("count_mismatch"))
        .when(F.col("ids_sha256") != F.col("__want"), F.lit("ids_mismatch")))
    return both.withColumn("check", check).where(F.col("check").isNotNull()).select("shard", "check")
