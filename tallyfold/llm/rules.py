"""Quality rules: a decision list learned by sequential covering.

Statistics of whole texts (words, symbols, repeated lines and windows, letter case) describe a document. From a bounded sample of
labelled rows, rules "statistic <= or > threshold, and ..." that cover bad documents are grown one condition at a time by
information gain, pruned on rows held back, and put in a list until no further rule is worth it. The list becomes one Spark
conditional expression, first match first.

Null texts are empty (no words). Repeated rows and repeated or null doc_ids are judged one by one. Without labels of both kinds no
rule is learned and every document passes. An empty table gives an empty result. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import only

#: ASCII white space: the separators of words.
SPACE = re.compile(r"[\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marked", "n_distinct")
#: Derived statistics, by name: numerator and denominator among COUNTS.
RATIOS = {
    "mean_word": ("word_chars", "n_words"), "symbol_share": ("n_symbols", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"), "upper_share": ("n_upper", "word_chars"), "marked_share": ("n_marked", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
}
FEATURES = ("n_words", *RATIOS)
#: Labelled rows that the rules are learned from, at most.
SAMPLE_ROWS = 12_000
MAX_RULES = 12
MAX_CONDITIONS = 4
#: Least precision of a rule on the rows held back.
MIN_PRECISION = 0.8
BASE = np.uint64(0x9E3779B97F4A7C15)

Rule = list[tuple[str, str, float]]


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows that occur twice or more. codes: an integer for each word. Windows are compared by a 64-bit hash that is
    built by doubling: words, pairs, fours, eights."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    h, width = (codes.astype(np.uint64) + np.uint64(1)) * BASE, 1
    while width < window:
        h = h ^ (h >> np.uint64(29))
        h = h[:-width] * BASE + (h[width:] ^ (h[width:] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        width *= 2
    order = np.sort(h)
    if not (order[1:] == order[:-1]).any():
        return 0
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    edges = np.zeros(len(codes) + 1, np.int64)
    starts = np.flatnonzero(counts[inverse] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def counts_of(text: str) -> tuple[int, ...]:
    """The values of COUNTS."""
    words = [w for w in SPACE.split(text) if w]
    if not words:
        return (0, 0, len(SYMBOLS.findall(text)), *[0] * 6)
    names: dict[str, int] = {}
    codes = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    lines, seen, n_dup, n_lines = text.split("\n"), set(), 0, 0
    for line in lines:
        if SPACE.sub("", line):
            n_lines += 1
            if line in seen:
                n_dup += 1
            else:
                seen.add(line)
    word_chars = sum(map(len, words))
    lower = text.lower()
    n_upper = sum(1 for a, b in zip(text, lower, strict=False) if a != b) if len(lower) == len(text) and lower != text else 0
    marked = sum(c for w, c in zip(names, np.bincount(codes).tolist(), strict=True) if not w[-1].isalnum() and not w[-2:-1].isalnum())
    return (len(words), word_chars, len(SYMBOLS.findall(text)), n_dup, repeated_words(codes), n_lines, n_upper, marked, len(names))


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns ``keep`` and COUNTS; a row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([counts_of(t or "") for t in batch.column("text").to_pylist()], np.int64).reshape(-1, len(COUNTS))
            kept = [n for n in batch.schema.names if n != "text"]
            yield pa.record_batch([*[batch.column(n) for n in kept], *map(pa.array, np.ascontiguousarray(values.T))], [*kept, *COUNTS])

    types = dict(docs.dtypes)
    schema = ", ".join([*[f"`{n}` {types[n]}" for n in ("doc_id", *keep)], *[f"{n} long" for n in COUNTS]])
    return only(docs, "doc_id", *keep, "text").mapInArrow(run, schema)


def feature(name: str) -> Column:
    """A statistic as a Spark expression over COUNTS; shares of nothing are 0."""
    if name not in RATIOS:
        return F.col(name).cast("double")
    top, bottom = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and quality of at most ``rows`` labelled documents: those of the smallest hashes of doc_id, whatever the table's size."""
    chosen = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return statistics(only(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id"), "quality")  # at most SAMPLE_ROWS pairs of numbers


def _covered(x: np.ndarray, rule: list[tuple[int, str, float]]) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for j, op, t in rule:
        hit &= x[:, j] > t if op == ">" else x[:, j] <= t
    return hit


def _grow(x: np.ndarray, bad: np.ndarray) -> list[tuple[int, str, float]]:
    rule: list[tuple[int, str, float]] = []
    hit = np.ones(len(x), bool)
    while len(rule) < MAX_CONDITIONS and (~bad[hit]).any():
        p, n = bad[hit].sum(), hit.sum()
        best = (0.0, None)
        for j in range(x.shape[1]):
            v, y = x[hit, j], bad[hit]
            order = np.argsort(v, kind="stable")
            v, y = v[order], y[order]
            ends = np.flatnonzero(v[1:] > v[:-1])
            if not len(ends):
                continue
            tp = np.cumsum(y)[ends]
            size = ends + 1
            for op, good, of in (("<=", tp, size), (">", p - tp, n - size)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(good > 0, good * (np.log2(good / of) - np.log2(p / n)), 0.0)
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), (j, op, float((v[ends[k]] + v[ends[k] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        hit &= _covered(x, rule[-1:])
    return rule


def _prune(rule: list[tuple[int, str, float]], x: np.ndarray, bad: np.ndarray) -> tuple[list[tuple[int, str, float]], float, int]:
    """The prefix that is best on the rows held back, its precision and what it covers."""
    scored = []
    for k in range(1, len(rule) + 1):
        hit = _covered(x, rule[:k])
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        scored.append(((p - n) / max(1, p + n), p, -k, p / max(1, p + n)))
    value = max(scored) if scored else (0.0, 0, 0, 0.0)
    return rule[: -value[2]], value[3], value[1]


def learned(rows: list[tuple], seed: int = 7) -> list[Rule]:
    """Rules for bad documents, in order. rows: quality and the values of FEATURES."""
    if not rows:
        return []
    data = np.array(sorted(rows), float)
    data = data[np.random.default_rng(seed).permutation(len(data))]
    bad, x = data[:, 0] == 0, data[:, 1:]
    held = np.arange(len(data)) % 3 == 0
    rules, left = [], np.ones(len(data), bool)
    while len(rules) < MAX_RULES:
        grow, test = left & ~held, left & held
        if bad[grow].sum() < 5 or not (~bad[grow]).any():
            break
        rule, precision, hits = _prune(_grow(x[grow], bad[grow]), x[test], bad[test])
        if not rule or precision < MIN_PRECISION or hits < 2:
            break
        rules.append([(FEATURES[j], op, t) for j, op, t in rule])
        left &= ~_covered(x, rule)
    return rules


def fitted(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[Rule]:
    found = sample(docs, labels, rows).select("quality", *[feature(n).alias(n) for n in FEATURES]).collect()  # at most SAMPLE_ROWS
    return learned([tuple(r) for r in found])


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that matches, from 1; 0 if none does: an ordered conditional expression."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = F.lit(True)
        for name, op, t in rule:
            test = test & (feature(name) > t if op == ">" else feature(name) <= t)
        out = F.when(test, k) if out is None else out.when(test, k)
    return F.lit(0) if out is None else out.otherwise(0)


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, COUNTS and rule (0: passes)."""
    return statistics(docs).withColumn("rule", verdict(rules))
