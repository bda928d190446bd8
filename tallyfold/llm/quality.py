"""Quality classifier: ordinal cumulative-link regression over hashed text features.

Labelled rows have the grades 0, 1, 2 (quality plus one if not toxic: 2 is good and clean, 1 fails in one respect, 0 in both). One
weight per hashed feature is shared by all grades, and ordered thresholds cut the score w*x into grades:

    P(grade <= k) = sigmoid(threshold_k - w*x)

Features say which words, endings and shapes a whole text has. The fit is a proximal gradient descent with an L1 penalty on at most
``SAMPLE_ROWS`` labelled rows; scoring covers every document.

Null texts are empty. Repeated rows and repeated or null doc_ids are scored one by one. Labels with a null are left out; with fewer
than two grades among them nothing is learned, scores are null and every document is kept. An empty table gives an empty result.
Columns other than doc_id and text are passed through or ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import only, unused

GRADES = 3
BUCKETS = 1 << 20
#: Labelled rows that the model is fitted on, at most.
SAMPLE_ROWS = 12_000
#: A feature has to occur in so many rows of the sample.
MIN_ROWS = 6
#: Least distance of the mean grade of a feature's rows from that of all, in standard errors.
SCREEN = 4.0
L1, ROUNDS = 5e-5, 250
#: Least probability of the top grade for a document to be kept.
KEEP = 0.5
MEMO_ENTRIES = 400_000


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def word_features(word: str) -> tuple[int, ...]:
    """A word without its marks, how it begins, and the marks at its end."""
    core = word.strip("\"'.,;:!?()[]{}#*$%&|<>-_")
    tail = word[len(word.rstrip("\"'.,;:!?()[]{}#*$%&|<>-_")) :]
    core = core.lower()
    out = [bucket("w:" + core), bucket("4:" + core[:4]), bucket("5:" + core[:5])] if core else []
    if tail:
        out.append(bucket("t:" + tail[:4]))
    return tuple(out)


def shape_features(text: str, words: list[str], different: int) -> list[int]:
    """Shares of letter case, different words, marks, digits and repeated lines, each in ten steps."""
    n = len(words)
    lines = [line for line in text.split("\n") if line.strip()]
    step = lambda part, whole: min(9, int(10 * part / whole)) if whole else 0
    marked = sum(text.count(c) for c in "#*$%&|<>!")
    upper = sum(map(str.isupper, words))
    shapes = {
        "upper": step(upper, n), "different": step(different, n), "marked": step(marked, n), "lines": step(len(set(lines)), len(lines)),
        "length": min(12, n.bit_length()), "word": min(20, len(text) // (n + 1)),
    }
    return [bucket(f"s:{k}:{v}") for k, v in shapes.items()]


class Features:
    """Sorted different features of a text; words are looked up in a memo that starts anew when it is full."""

    def __init__(self) -> None:
        self.memo: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.split()
        different = set(words)
        out: set[int] = set(shape_features(text, words, len(different)))
        memo = self.memo
        for word in different:
            got = memo.get(word)
            if got is None:
                if len(memo) >= MEMO_ENTRIES:
                    memo.clear()
                got = memo[word] = word_features(word)
            out.update(got)
        return np.array(sorted(out), np.int32)


@dataclass
class Model:
    weights: dict[int, float]
    thresholds: list[float]


def fit(rows: list[tuple[int, bytes]]) -> Model | None:
    """rows: grade and features (32-bit integers as bytes). They are put in one order first, so that the fit doesn't depend on theirs."""
    rows = sorted(rows)
    y = np.array([g for g, _ in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return None
    size = np.array([len(f) // 4 for _, f in rows], np.int64)
    every = np.frombuffer(b"".join(f for _, f in rows), "<i4")
    row = np.repeat(np.arange(len(rows), dtype=np.int32), size)
    names, at, seen = np.unique(every, return_inverse=True, return_counts=True)
    mean = np.bincount(at, weights=y[row].astype(float)) / seen
    often = (seen >= min(MIN_ROWS, max(1, len(rows) // 20))) & (np.abs(mean - y.mean()) * np.sqrt(seen) >= SCREEN * y.std())
    names, new = names[often], np.cumsum(often) - 1
    take = often[at]
    row, col = row[take], new[at[take]]
    n, d = len(rows), len(names)
    present = np.unique(y)
    # one threshold between neighbouring grades that occur
    cuts = present[1:]
    share = np.array([(y < c).mean() for c in cuts])
    theta = np.log(share / (1 - share))
    w, v, momentum = np.zeros(d), np.zeros(d), 0.0
    # a step for each feature, by how often it occurs and how long its rows are
    length = np.bincount(row, minlength=n).astype(float)
    curve = np.bincount(col, weights=length[row], minlength=d) / (4 * n) + 1e-9
    step = 1.0 / curve
    for _ in range(ROUNDS):
        score = np.bincount(row, weights=v[col], minlength=n)
        below = 1 / (1 + np.exp(-np.clip(theta[None, :] - score[:, None], -40, 40)))  # P(grade < cut)
        full = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        k = np.searchsorted(present, y)
        hi, lo = full[np.arange(n), k + 1], full[np.arange(n), k]
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        slope = (dhi - dlo) / p / n  # d(-log p) / d score
        grad = np.bincount(col, weights=slope[row], minlength=d)
        new_w = v - step * grad
        new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * L1, 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v = new_w + (momentum - 1) / following * (new_w - w) if momentum else new_w
        w, momentum = new_w, following
        for c in range(len(theta)):
            push = np.where(k == c, dhi, 0) - np.where(k == c + 1, dlo, 0)
            theta[c] += 0.5 * np.mean(push / p)
        theta = np.maximum.accumulate(theta)
    kept = np.flatnonzero(w)
    thresholds = [-np.inf] * (GRADES - 1)
    for g in range(1, GRADES):  # P(grade < g): the cut of the least grade that occurs from g on
        later = [i for i, c in enumerate(cuts) if c >= g]
        thresholds[g - 1] = float(theta[later[0]]) if later and g > present[0] else (-np.inf if g <= present[0] else np.inf)
    return Model({int(names[j]): float(w[j]) for j in kept}, thresholds)


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[int, bytes]]:
    """Grade and features of at most ``rows`` labelled documents: those of the smallest hashes of doc_id, whatever the table's size."""
    graded = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg((F.min("quality") + 1 - F.max("toxic")).cast("int").alias("grade"))
    chosen = graded.where(F.col("grade").between(0, GRADES - 1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features(t or "").astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("grade"), pa.array(found, pa.binary())], ["grade", "features"])

    joined = only(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id").select("grade", "text")  # at most SAMPLE_ROWS pairs of numbers
    table = joined.mapInArrow(run, "grade int, features binary").toArrow()
    return list(zip(table.column("grade").to_pylist(), table.column("features").to_pylist(), strict=True))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with expected_grade, p_top (probability of the top grade) and accepted."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, value = Features(), (model.weights if model else {}).get
        cuts = np.array(model.thresholds) if model else None
        for batch in batches:
            n = batch.num_rows
            if model:
                score = np.array([sum([value(j, 0.0) for j in features(t or "").tolist()]) for t in batch.column("text").to_pylist()], float)
                with np.errstate(over="ignore"):
                    above = 1 - 1 / (1 + np.exp(-(cuts[None, :] - score.reshape(-1, 1))))  # P(grade >= 1), P(grade >= 2)
                extra = [pa.array(above.sum(axis=1)), pa.array(above[:, -1]), pa.array(above[:, -1] >= KEEP)]
            else:
                extra = [pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()), pa.array([True] * n, pa.bool_())]
            yield pa.record_batch([*batch.columns, *extra], [*batch.schema.names, "expected_grade", "p_top", "accepted"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema], "expected_grade double, p_top double, accepted boolean"])
    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose top grade is likely enough. Columns as in docs."""
    names = {}
    for n in ("expected_grade", "p_top", "accepted"):
        if n in docs.columns:
            names[n] = unused(docs, f"__{n}")
    out = scored(docs.withColumnsRenamed(names), fit(sample(docs, labels))).where("accepted").drop("expected_grade", "p_top", "accepted")
    return out.withColumnsRenamed({v: k for k, v in names.items()})
