"""Schemas of the tables the library reads. Target names are always a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T


def all_strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
_NUM_MAP = T.MapType(T.StringType(), T.DoubleType())

# Target values are kept as JSON text: an object for a report state, a number for a numeric label.
ENVELOPE = T.StructType([
    T.StructField("StudyInstanceUID", T.StringType()),
    T.StructField("uid", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("ontology_version", T.StringType()),
    T.StructField("payload", T.StructType([
        T.StructField("StudyInstanceUID", T.StringType()),
        T.StructField("ontology_version", T.StringType()),
        T.StructField("targets", _TEXT_MAP),
    ])),
    T.StructField("targets", _TEXT_MAP),
    T.StructField("y", _TEXT_MAP),
    T.StructField("y_mask", _NUM_MAP),
    T.StructField("y_weight", _NUM_MAP),
])

FINDING = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("evidence_span", T.StringType()),
    T.StructField("evidence_start", T.IntegerType()),
    T.StructField("evidence_end", T.IntegerType()),
    T.StructField("severity", T.StringType()),
    T.StructField("size", T.StringType()),
    T.StructField("compartment", T.StringType()),
    T.StructField("acuity", T.StringType()),
    T.StructField("laterality", T.StringType()),
    T.StructField("criterion_mapping", T.StringType()),
    T.StructField("llm_confidence", T.DoubleType()),
])

EXTRACTION = T.StructType([
    T.StructField("StudyInstanceUID", T.StringType()),
    T.StructField("targets", T.MapType(T.StringType(), FINDING)),
])

SOFT_LABELS = T.StructType([
    T.StructField("StudyInstanceUID", T.StringType()),
    T.StructField("soft_targets", _NUM_MAP),
    T.StructField("target_weights", _NUM_MAP),
])

SLICE_HEADER = T.StructType([
    T.StructField("study", T.StringType()),
    T.StructField("series", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("iop", T.ArrayType(T.DoubleType())),
    T.StructField("ipp", T.ArrayType(T.DoubleType())),
    T.StructField("instance", T.IntegerType()),
    T.StructField("sop", T.StringType()),
    T.StructField("spacing", T.ArrayType(T.DoubleType())),
    T.StructField("slope", T.DoubleType()),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("photometric", T.StringType()),
    T.StructField("rows", T.IntegerType()),
    T.StructField("cols", T.IntegerType()),
])
