"""Row predicates and cell-level label rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.scale import col

# Cell texts that count as missing, whitespace that is stripped,
# label states with their training value and weight.
MISSING_TEXTS = ("", "nan", "NaN", "None")
STRIP_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
STATES = ("criterion_positive", "explicit_negative", "uncertain", "not_mentioned", "borderline_negative_hint")
STATE_VALUE = {"criterion_positive": 1.0, "explicit_negative": 0.0, "borderline_negative_hint": 0.0}
STATE_WEIGHT = {"criterion_positive": 0.25, "explicit_negative": 0.25, "borderline_negative_hint": 0.15}
SYNTHETIC_PREFIXES = ("syn-", "synthetic-")


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(STRIP_CHARS))


def nonempty(value: Column) -> Column:
    text = strip(value.cast("string"))
    return F.coalesce(~text.isin(*MISSING_TEXTS), F.lit(False))


def all_nonempty(targets: Sequence[str]) -> Column:
    """Gold flag: every target cell is filled."""
    return reduce(lambda a, b: a & b, [nonempty(col(t)) for t in targets])


def finite(value: Column) -> Column:
    v = value.cast("double")
    return F.coalesce(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), F.lit(False))


def is_probability(value: Column) -> Column:
    return finite(value) & F.coalesce(value.cast("double").between(0.0, 1.0), F.lit(False))


def parse_number(text: Column) -> Column:
    """Text to a finite double, anything else to null."""
    v = strip(text.cast("string")).try_cast("double")
    return F.when(finite(v), v)


def safe_id(uid: Column) -> Column:
    text = uid.cast("string")
    shape = text.rlike(r"(?U)^[\p{Alnum}._-]{1,240}\z")
    return F.coalesce(shape & ~text.isin(".", ".."), F.lit(False))


def synthetic_id(uid: Column) -> Column:
    return reduce(lambda a, b: a | b, [uid.startswith(p) for p in SYNTHETIC_PREFIXES])


def soft_target(value: Column) -> Column:
    """Null and -1 become null; a value outside [0, 1] or not finite stays for ``soft_target_error``."""
    v = value.cast("double")
    return F.when(is_probability(v), v)


def soft_target_error(value: Column) -> Column:
    v = value.cast("double")
    return v.isNotNull() & F.coalesce(v != -1.0, F.lit(True)) & ~is_probability(v)


def _label(y: Column, weight: Column) -> Column:
    seen = y.isNotNull()
    return F.struct(
        y.alias("y"),
        F.when(seen, F.lit(1.0)).otherwise(F.lit(0.0)).alias("mask"),
        F.when(seen, weight).otherwise(F.lit(0.0)).alias("weight"),
    )


def gold_label(value: Column) -> Column:
    """Trusted cell text to struct(y, mask, weight): 0/1 count, everything else is masked."""
    v = strip(value.cast("string")).try_cast("double")
    return _label(F.when(v.isin(0.0, 1.0), v), F.lit(1.0))


def _lookup(table: dict[str, float], key: Column) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def state_label(state: Column) -> Column:
    """Report state to struct(y, mask, weight); uncertain, unmentioned and unknown states are masked."""
    return _label(_lookup(STATE_VALUE, F.coalesce(state, F.lit("not_mentioned"))), _lookup(STATE_WEIGHT, state))


def numeric_label(raw: Column, mask: Column, weight: Column) -> Column:
    """Numeric cell to struct(y, mask, weight).

    A mask entry, where there is one, decides whether the cell counts; without one
    a nonempty cell counts. Only 0 and 1 are kept and the weight defaults to 1.
    """
    text = raw.cast("string")
    present = F.when(mask.isNotNull(), (mask > 0) & raw.isNotNull()).otherwise(
        F.coalesce(~text.isin(*MISSING_TEXTS), F.lit(False)))
    v = strip(text).try_cast("double")
    return _label(F.when(present & v.isin(0.0, 1.0), v), F.coalesce(weight, F.lit(1.0)))


def confident(probs: Sequence[Column], low: float = 0.1, high: float = 0.9) -> Column:
    """True when any of the given soft labels is decisive."""
    hits = [F.coalesce((p <= low) | (p >= high), F.lit(False)) for p in probs]
    return reduce(lambda a, b: a | b, hits)


def clip(value: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), value))


def laterality_mismatch(image_side: Column, requested: Column) -> Column:
    a, b = F.lower(F.substring(image_side, 1, 1)), F.lower(F.substring(requested, 1, 1))
    return F.coalesce(a.isin("l", "r") & b.isin("l", "r") & (a != b), F.lit(False))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-clip(x, -60.0, 60.0)))


def remote_score(text: Column) -> Column:
    """Published score text to a double when it is a finite value in [0, 1]."""
    v = parse_number(text)
    return F.when(v.between(0.0, 1.0), v)


def remote_status(text: Column) -> Column:
    """Last dotted part of a status name, upper-cased."""
    return F.element_at(F.split(F.upper(F.coalesce(text.cast("string"), F.lit(""))), r"\."), -1)
