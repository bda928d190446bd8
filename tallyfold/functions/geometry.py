"""Slice geometry as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plane names by dominant normal axis, and per plane the sign of the
# slice direction, the (axis, sign) of image columns and the (axis, sign) of rows.
PLANES = ("Sagittal", "Coronal", "Axial")
CANONICAL = ((1, (1, 1), (2, -1)), (1, (0, 1), (2, -1)), (-1, (0, 1), (1, 1)))


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def slice_normal(iop: Column) -> Column:
    """Unit normal of a slice from its six direction cosines, null when unusable."""
    v = [F.get(iop, F.lit(i)).cast("double") for i in range(6)]
    n = cross(v[:3], v[3:])
    norm = F.sqrt(n[0] * n[0] + n[1] * n[1] + n[2] * n[2])
    ok = (F.size(iop) >= 6) & (norm >= 1e-8)
    return F.when(ok, F.array(*[F.try_divide(x, norm) for x in n]))


def dot3(a: Column, b: Column) -> Column:
    return sum((F.get(a, F.lit(i)) * F.get(b, F.lit(i)) for i in (1, 2)), F.get(a, F.lit(0)) * F.get(b, F.lit(0)))


def projection(normal: Column, ipp: Column) -> Column:
    """Position of a slice along its own normal."""
    return F.when(F.size(ipp) >= 3, dot3(normal, ipp))


def dominant_plane(normal: Column) -> Column:
    """Index of the largest absolute component (0, 1 or 2; first wins a tie)."""
    a = F.transform(normal, lambda x: F.abs(x))
    return F.array_position(a, F.array_max(a)).cast("int") - 1


def half_even(x: Column) -> Column:
    return F.rint(x).cast("long")


def crop_box(rows: Column, cols: Column, spacing: Column, crop_mm: float = 160.0) -> Column:
    """struct(r0, r1, c0, c1, mode): centred physical crop, square when spacing is missing."""
    s0, s1 = F.get(spacing, F.lit(0)), F.get(spacing, F.lit(1))
    known = F.coalesce(F.least(s0, s1) > 0, F.lit(False)) & s0.isNotNull() & s1.isNotNull()
    side = F.least(rows, cols)
    h = F.when(known, F.least(rows, F.greatest(F.lit(1), half_even(F.try_divide(F.lit(crop_mm), s0))))).otherwise(side)
    w = F.when(known, F.least(cols, F.greatest(F.lit(1), half_even(F.try_divide(F.lit(crop_mm), s1))))).otherwise(side)
    r0 = F.greatest(F.lit(0), F.floor((rows - h) / 2)).cast("long")
    c0 = F.greatest(F.lit(0), F.floor((cols - w) / 2)).cast("long")
    mode = F.when(known, F.lit("pixel_spacing_mm")).otherwise(F.lit("missing_spacing_square_fallback"))
    return F.struct(r0.alias("r0"), (r0 + h).alias("r1"), c0.alias("c0"), (c0 + w).alias("c1"), mode.alias("mode"))


def orientation(iop: Column, spacing: Column, plane: Column) -> Column:
    """struct(transpose, flip_col, flip_row, s0, s1, reason) for bringing a slice to the canonical view."""
    r = [F.get(iop, F.lit(i)).cast("double") for i in range(3)]
    c = [F.get(iop, F.lit(i)).cast("double") for i in range(3, 6)]
    s0, s1 = F.get(spacing, F.lit(0)).cast("double"), F.get(spacing, F.lit(1)).cast("double")

    def by_plane(fn) -> Column:
        out = F.when(plane == 0, fn(CANONICAL[0]))
        for i in (1, 2):
            out = out.when(plane == i, fn(CANONICAL[i]))
        return out

    transpose = by_plane(lambda k: F.abs(r[k[1][0]]) < F.abs(r[k[2][0]]))

    def along(axis_of, straight: list[Column], swapped: list[Column]) -> Column:
        return F.when(transpose, by_plane(lambda k: swapped[axis_of(k)])).otherwise(
            by_plane(lambda k: straight[axis_of(k)]))

    col_dir = along(lambda k: k[1][0], r, c)
    row_dir = along(lambda k: k[2][0], c, r)
    reason = (
        F.when(F.coalesce(F.size(iop) != 6, F.lit(True)) | iop.isNull(), F.lit("missing_iop"))
        .when(spacing.isNull() | F.coalesce(F.size(spacing) != 2, F.lit(True)) | F.coalesce(F.least(s0, s1) <= 0, F.lit(True)),
              F.lit("missing_or_invalid_spacing"))
        .when((F.abs(col_dir) < 0.7) | (F.abs(row_dir) < 0.7), F.lit("unsupported_in_plane_geometry"))
    )
    ok = reason.isNull()
    return F.struct(
        F.when(ok, transpose).alias("transpose"),
        F.when(ok, col_dir * by_plane(lambda k: F.lit(k[1][1])) < 0).alias("flip_col"),
        F.when(ok, row_dir * by_plane(lambda k: F.lit(k[2][1])) < 0).alias("flip_row"),
        F.when(ok, F.when(transpose, s1).otherwise(s0)).alias("s0"),
        F.when(ok, F.when(transpose, s0).otherwise(s1)).alias("s1"),
        reason.alias("reason"))


def resample_box(rows: Column, cols: Column, s0: Column, s1: Column, size: int, crop_mm: float) -> Column:
    """struct(y, x, h, w, new_h, new_w, pad_h, pad_w): numbers of a physical crop and resize."""
    mm = crop_mm / size
    h = F.least(rows, F.greatest(F.lit(1), half_even(F.try_divide(F.lit(crop_mm), s0))))
    w = F.least(cols, F.greatest(F.lit(1), half_even(F.try_divide(F.lit(crop_mm), s1))))
    nh = F.greatest(F.lit(1), F.least(F.lit(size), half_even(h * s0 / mm)))
    nw = F.greatest(F.lit(1), F.least(F.lit(size), half_even(w * s1 / mm)))
    return F.struct(
        F.floor((rows - h) / 2).alias("y"), F.floor((cols - w) / 2).alias("x"), h.alias("h"), w.alias("w"),
        nh.alias("new_h"), nw.alias("new_w"), (F.lit(size) - nh).alias("pad_h"), (F.lit(size) - nw).alias("pad_w"))
