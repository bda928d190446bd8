"""Series selection per slot and slice ordering by geometry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.arrays import (
    duplicate_count,
    encode_uint8,
    invert_monochrome,
    neighbour_triplets,
    percentile_clip,
    rescale,
    series_centers,
    to_unit,
    with_window,
)
from tallyfold.functions.geometry import PLANES, crop_box, dominant_plane, dot3, projection, slice_normal
from tallyfold.operators.extraction import first_rows
from tallyfold.operators.radix import array_quantiles
from tallyfold.scale import cols, ordinal_rank, pin

KEY = ("study", "series")


def select_slots(series: DataFrame, slots: Sequence[tuple[str, str]]) -> DataFrame:
    """(study, slot, series): the best unused series for each slot, null when none fits.

    ``series`` is (study, series, plane, fluid, fat, n). Within a plane a fluid slot and a
    structural slot never want the same series, and repeated slots of one kind take the
    best, second best and so on, so one ranking per (study, plane, kind) settles all slots.
    """
    if any(k not in {"fluid", "structural"} for _, k in slots):
        raise ValueError("unknown slot kind")
    kinds: dict[tuple[str, str], list[int]] = {}
    for i, s in enumerate(slots):
        kinds.setdefault(s, []).append(i)
    fluid = F.coalesce(F.col("fluid"), F.lit(""))
    wants = []
    for plane, kind in kinds:
        fits = F.col("plane") == plane
        if kind == "structural":
            fits &= fluid == "0"
        elif (plane, "structural") in kinds:
            fits &= fluid != "0"
        desired = (fluid == "1") if kind == "fluid" else (fluid != "1")
        wants.append(F.when(fits, F.struct(F.lit(kind).alias("kind"), desired.alias("desired"))))
    cand = series.select("study", "series", "plane", "fat", "n", F.explode(F.array_compact(F.array(*wants))).alias("w"))
    rank = F.struct(
        F.when(F.col("n") > 0, 0).otherwise(1).alias("a"), F.when(F.col("w.desired"), 0).otherwise(1).alias("b"),
        F.when(F.col("fat") == "1", 0).otherwise(1).alias("c"), (-F.col("n")).alias("d"), F.col("series").alias("e"))
    best = cand.groupBy("study", "plane", F.col("w.kind").alias("kind"), "series").agg(F.min(rank).alias("rank"))
    ranked = first_rows(best, ["study", "plane", "kind"], [F.col("rank")], max(len(v) for v in kinds.values()), "k")
    index = F.array(*[
        F.struct(F.lit(p).alias("plane"), F.lit(k).alias("kind"), F.lit(j + 1).alias("k"), F.lit(i).alias("slot"))
        for (p, k), where in kinds.items() for j, i in enumerate(where)])
    chosen = ranked.withColumn("slot", F.get(F.filter(index, lambda x: (x["plane"] == F.col("plane")) & (
        x["kind"] == F.col("kind")) & (x["k"] == F.col("k"))), F.lit(0))["slot"]).where(F.col("slot").isNotNull())
    grid = series.select("study").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(len(slots) - 1))))
    return grid.join(chosen.select("study", "slot", "series"), ["study", "slot"], "left")


def slot_candidates(series: DataFrame) -> DataFrame:
    """(study, slot, position, series, n): all candidates per slot, longest first. Slot = plane + 3 * (1 - fat)."""
    plane = F.array_position(F.array(*[F.lit(p) for p in PLANES]), F.col("plane")).cast("int") - 1
    rows = series.where(F.col("plane").isin(*PLANES) & F.col("fat").isin("0", "1")).select(
        "study", (plane + 3 * (1 - F.col("fat").cast("int"))).alias("slot"), "series", "n")
    ranked = ordinal_rank(rows, ["study", "slot"], [F.col("n").desc(), F.col("series")], "position")
    return ranked.withColumn("position", F.col("position") - 1)


def with_projection(headers: DataFrame) -> DataFrame:
    """Add the slice normal and the slice position along it."""
    return headers.withColumn("normal", slice_normal(F.col("iop"))).withColumn("proj", projection(F.col("normal"), F.col("ipp")))


def _first_pass(headers: DataFrame) -> DataFrame:
    """Per series: counts, the first usable normal and the geometry of the first slice."""
    return headers.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.count("proj").alias("n_proj"), F.count("instance").alias("n_inst"),
        F.min_by("normal", F.when(F.col("normal").isNotNull(), F.col("path"))).alias("ref"),
        F.min_by(F.struct("normal", "iop"), "path").alias("r"))


def _coherent() -> Column:
    return F.coalesce(F.bool_and(F.abs(dot3(F.col("ref"), F.col("normal"))) > 0.95), F.lit(True))


def _mode(prefix: str = "") -> Column:
    n, n_proj, n_inst, coherent = (F.col(prefix + c) for c in ("n", "n_proj", "n_inst", "coherent"))
    return (
        F.when((n_proj == n) & coherent, F.lit("iop_ipp"))
        .when(n_inst == n, F.lit("instance_number_fallback"))
        .otherwise(F.lit("path_fallback_not_sop_lex")))


def slice_modes(headers: DataFrame) -> DataFrame:
    """Per series: slice count, first usable normal and the ordering mode its headers allow."""
    h = with_projection(headers.select(*KEY, "path", "instance", "iop", "ipp"))
    base = _first_pass(h).drop("r")
    coherent = h.select(*KEY, "normal").join(base.select(*KEY, "ref"), list(KEY)).groupBy(*KEY).agg(_coherent().alias("coherent"))
    return base.join(coherent, list(KEY)).withColumn("mode", _mode())


def _keyed(headers: DataFrame) -> DataFrame:
    """The slices of known series, with normal and projection."""
    return with_projection(headers.where(F.col("study").isNotNull() & F.col("series").isNotNull()))


def _placed(h: DataFrame) -> DataFrame:
    """Add to every slice of ``_keyed`` rows what ``_first_pass`` says of its series (names with two underscores), the mode and ``order_slices``' columns.

    Every window is by series, so rows are shuffled once, and not at all if they come partitioned by series. A series is one scan; its
    slices are sorted in one task, which spills.
    """
    series = Window.partitionBy(*KEY)
    usable = F.when(F.col("normal").isNotNull(), F.col("path"))
    h = h.withColumns({
        "__n": F.count(F.lit(1)).over(series), "__n_proj": F.count("proj").over(series), "__n_inst": F.count("instance").over(series),
        "__ref": F.min_by("normal", usable).over(series), "__r": F.min_by(F.struct("normal", "iop"), "path").over(series)})
    aligned = F.bool_and(F.abs(dot3(F.col("__ref"), F.col("normal"))) > 0.95).over(series)
    h = h.withColumn("__coherent", F.coalesce(aligned, F.lit(True))).withColumn("mode", _mode("__"))
    key = F.when(F.col("mode") == "iop_ipp", F.col("proj")).when(
        F.col("mode") == "instance_number_fallback", F.col("instance").cast("double")).otherwise(F.lit(0.0))
    along = series.orderBy("__key", "path")
    return h.withColumn("__key", key).withColumns({
        "position": F.row_number().over(along).cast("long") - 1, "proj_prev": F.lag("proj").over(along)}).drop("__key")


def order_slices(headers: DataFrame) -> DataFrame:
    """Add mode, projection, the 0-based position of every slice in its series and the projection of the slice before."""
    return _placed(_keyed(headers)).drop("normal", "__n", "__n_proj", "__n_inst", "__ref", "__r", "__coherent")


def through_plane_geometry(ordered: DataFrame) -> DataFrame:
    """Per series: median and largest gap and the extent; null when a projection is missing or n < 2."""
    return _geometry(ordered, [])


def _geometry(ordered: DataFrame, more: Sequence[Column]) -> DataFrame:
    """``through_plane_geometry`` with more aggregates of the series."""
    g, series = list(KEY), Window.partitionBy(*KEY)
    gap = F.when(F.col("position") > 0, F.col("proj") - F.col("proj_prev"))
    gaps = ordered.withColumn("__gap", gap).withColumns({
        "__k": F.row_number().over(series.orderBy(F.col("__gap").asc_nulls_last(), "position")) - 1,
        "__middle": (F.count("__gap").over(series) - 1) * F.lit(0.5)})
    lo, hi = (F.max(F.when(F.col("__k") == f("__middle"), F.col("__gap"))) for f in (F.floor, F.ceil))
    base = gaps.groupBy(*g).agg(
        F.count(F.lit(1)).alias("__count"), F.count("proj").alias("__n_proj"), F.max("__gap").alias("__top"),
        (F.max_by("proj", "position") - F.min_by("proj", "position")).alias("__extent"),
        (lo + (hi - lo) * F.max(F.col("__middle") - F.floor("__middle"))).alias("__med"), *more)
    ok = (F.col("__count") >= 2) & (F.col("__n_proj") == F.col("__count"))
    extra = [c for c in base.columns if c not in g and not c.startswith("__")]
    return base.select(
        *g, F.when(ok, F.round("__med", 4)).alias("spacing_median"), F.when(ok, F.round("__top", 4)).alias("spacing_max"),
        F.when(ok, F.round("__extent", 3)).alias("extent"), *extra)


def series_qc(headers: DataFrame, planes: DataFrame) -> DataFrame:
    """(study, series, n, reason): first geometric failure of each series, null when it is usable.

    ``planes`` is (study, series, plane) from the series table.
    """
    g = list(KEY)
    rows = _placed(_keyed(headers.select(*KEY, "path", "instance", "sop", "iop", "ipp")))
    near = F.forall(F.zip_with("iop", F.col("__r.iop"), lambda a, b: F.abs(a - b) <= F.lit(0.02) + F.lit(1e-5) * F.abs(b)),
                    lambda x: F.coalesce(x, F.lit(False)))
    close = F.when((F.col("mode") == "iop_ipp") & (F.col("position") > 0), F.abs(F.col("proj") - F.col("proj_prev")) < 1e-5)
    checks = rows.groupBy(*g).agg(
        F.first("__n").alias("n"), F.first("__r").alias("r"), F.first("mode").alias("mode"),
        F.bool_or(F.col("normal").isNull()).alias("no_iop"),
        F.bool_or(dot3(F.col("__r.normal"), F.col("normal")) < 0.95).alias("incoherent"),
        F.bool_or(~near).alias("in_plane"), F.count_distinct("sop").alias("n_sop"), F.bool_or(close).alias("tight"))
    names = F.array(*[F.lit(p) for p in PLANES])
    reason = (
        F.when(F.col("n") < 3, F.lit("fewer_than_three_slices"))
        .when(F.col("no_iop"), F.lit("missing_iop"))
        .when(~F.get(names, dominant_plane(F.col("r.normal"))).eqNullSafe(F.col("plane")), F.lit("plane_metadata_geometry_mismatch"))
        .when(F.col("incoherent"), F.lit("incoherent_orientation"))
        .when(F.col("in_plane"), F.lit("incoherent_in_plane_orientation"))
        .when(F.col("n_sop") != F.col("n"), F.lit("duplicate_sop"))
        .when(F.col("mode") == "path_fallback_not_sop_lex", F.lit("missing_slice_order"))
        .when(F.coalesce("tight", F.lit(False)), F.lit("duplicate_slice_position")))
    return checks.join(planes.select(*g, "plane"), g, "left").select(*g, "n", reason.alias("reason"))


def thinned_positions(n: Column, max_slices: int) -> Column:
    """Evenly spread slice positions kept from a series of n slices."""
    k = F.least(n, F.lit(max_slices)).cast("int")
    step = F.try_divide((n - 1).cast("double"), (k - 1).cast("double"))
    spread = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.rint(i * step).cast("int"))
    return F.when(k == 1, F.array(F.lit(0))).otherwise(spread)


def series_plan(series: DataFrame, headers: DataFrame, slots: Sequence[tuple[str, str]], n_centers: int, *,
                lower: float = 0.15, upper: float = 0.85) -> DataFrame:
    """Chosen series per slot with centers, triplets, repeat counts and through-plane geometry."""
    counts = headers.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_slices"))
    sized = series.drop("n").join(counts, list(KEY), "left").withColumn("n", F.coalesce("n_slices", F.lit(0))).drop("n_slices")
    chosen = select_slots(sized, slots)
    used = headers.join(chosen.where(F.col("series").isNotNull()).select(*KEY), list(KEY), "left_semi")
    info = _geometry(order_slices(used.select(*KEY, "path", "instance", "iop", "ipp")), [F.count(F.lit(1)).alias("n"), F.first("mode").alias("mode")])
    info = info.withColumn("centers", series_centers(F.col("n"), n_centers, lower=lower, upper=upper))
    info = info.withColumn("triplets", neighbour_triplets(F.col("centers"), F.col("n"))).withColumn(
        "duplicate_centers", duplicate_count(F.col("centers")))
    return chosen.join(info, list(KEY), "left").withColumn("present", F.col("n").isNotNull())


def series_window(slices: DataFrame, values: str = "values", low: float = 0.5, high: float = 99.5) -> DataFrame:
    """(study, series, lo, hi): one intensity window over all pixels of a series; pixels never become rows."""
    g = list(KEY)
    q = array_quantiles(slices.select(*g, values), g, values, {"lo": low / 100, "hi": high / 100})
    ends = slices.groupBy(*g).agg(F.min(F.array_min(values)).alias("mn"), F.max(F.array_max(values)).alias("mx"))
    flat_window = F.col("hi") <= F.col("lo")
    return q.join(ends, g).select(
        *g, F.when(flat_window, F.col("mn")).otherwise(F.col("lo")).alias("lo"),
        F.when(flat_window, F.col("mx") + F.lit(1e-6)).otherwise(F.col("hi")).alias("hi"))


def fixed_values() -> Column:
    """Stored values with slope and intercept, dark on bright turned."""
    return invert_monochrome(rescale(F.col("values"), F.col("slope"), F.col("intercept")), F.col("photometric"))


def quantised(fixed: DataFrame, intensity: str) -> DataFrame:
    """Add ``q``: values scaled to 0..255 by each slice's own window or by its series' window."""
    if intensity == "slice":
        return fixed.withColumn("q", encode_uint8(to_unit(percentile_clip(F.col("values")))))
    if intensity != "series":
        raise ValueError("intensity must be 'slice' or 'series'")
    windows = series_window(fixed)
    return fixed.join(windows, list(KEY)).withColumn(
        "q", encode_uint8(with_window(F.col("values"), F.col("lo"), F.col("hi")))).drop("lo", "hi")


def slice_values(slices: DataFrame, intensity: str = "slice") -> DataFrame:
    """Rescale, invert, scale to [0, 1] per slice or per series, and quantise to 0..255."""
    return quantised(slices.withColumn("values", fixed_values()), intensity)


def cropped(values: Column, cols_: Column, box: Column) -> Column:
    """The part of a row-major array that lies in a crop box."""
    width = (box["c1"] - box["c0"]).cast("int")
    rows = F.sequence(box["r0"], box["r1"] - 1)
    return F.flatten(F.transform(rows, lambda r: F.slice(values, (r * cols_ + box["c0"] + 1).cast("int"), width)))


def center_slices(headers: DataFrame, slices: DataFrame, n_centers: int, *, strategy: str = "interior", lower: float = 0.15, upper: float = 0.85,
                  crop_mm: float = 160.0, intensity: str = "slice") -> DataFrame:
    """The slices around a series' centers, ordered, cropped, scaled and quantised: one row per slice that is used.

    ``headers`` is (study, series, path, instance, iop, ipp), ``slices`` (study, series, path, rows, cols, spacing, slope, intercept,
    photometric, values in row order). Returns study, series, path, mode, n_slices, position, places (array of center, neighbour: which
    of the triplets' cells the slice fills), crop and q. Only used slices are rescaled, and a series' window is taken over their crops.
    A used slice without pixels is an error of the input and has a null q.
    """
    g = list(KEY)
    modes = pin(slice_modes(headers))
    ordered = order_slices(headers).select(*g, "path", "position")
    triplets = neighbour_triplets(series_centers(F.col("n"), n_centers, strategy=strategy, lower=lower, upper=upper), F.col("n"))
    cells = modes.select(*g, "mode", F.col("n").alias("n_slices"), F.posexplode(triplets).alias("center", "triplet")).select(
        *g, "mode", "n_slices", "center", F.posexplode("triplet").alias("neighbour", "position"))
    used = cells.groupBy(*g, "mode", "n_slices", "position").agg(F.array_sort(F.collect_list(F.struct("center", "neighbour"))).alias("places"))
    named = pin(used.join(ordered, [*g, "position"]))  # at most 3 rows a center, read by the window and by the result
    box = crop_box(F.col("rows"), F.col("cols"), F.col("spacing"), crop_mm)
    pixels = slices.join(named.select(*g, "path"), [*g, "path"], "left_semi").withColumn("crop", box)
    fixed = pixels.withColumn("values", cropped(fixed_values(), F.col("cols"), F.col("crop"))).select(*g, "path", "crop", "values")
    return named.join(quantised(fixed, intensity).select(*g, "path", "crop", "q"), [*g, "path"], "left")
