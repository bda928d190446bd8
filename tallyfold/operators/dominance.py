"""Counting positive-negative pairs by the verdicts of several scorers at once.

The question "how many pairs does scorer A get wrong and scorer B get right" is a
dominance count: pairs (i, j) with a_i < b_j in every dimension. Building the pairs
is quadratic. Instead each dimension but the last is taken apart bit by bit: for
integers a < b there is exactly one bit where a has 0, b has 1 and all higher bits
agree. Emitting a row once per such bit turns one dimension into an equality key,
and the last dimension is the histogram count AUC uses. With n cases and d scorers
the work is n * log(n) ** (d - 1) rows, exact, and no group is ever squared.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.auc import histogram_auc
from tallyfold.scale import col, cols, join_on, pin, prefix_sums

WRONG, RIGHT = "wrong", "right"


def dense_codes(wide: DataFrame, keys: Sequence[str], scorers: Sequence[str]) -> DataFrame:
    """Add for every score its dense position among the distinct scores of the key, and how many there are.

    A missing score is a value of its own and stands first.
    """
    keys = list(keys)
    out = wide
    for s in scorers:
        values = wide.groupBy(*cols(keys), col(s)).agg(F.lit(1).cast("long").alias("__one"))
        codes = prefix_sums(values, keys, [col(s)], ["__one"], totals=True).select(
            *cols(keys), col(s), F.col("__one_before").alias(f"__code_{s}"), F.col("__one_total").alias(f"__top_{s}"))
        out = join_on(out, codes, [*keys, s])
    return out


def _sides(scorer: str, verdict: str) -> tuple[Column, Column]:
    """Codes (for a positive, for a negative) with code_pos < code_neg exactly when the verdict holds."""
    c, top = col(f"__code_{scorer}"), col(f"__top_{scorer}")
    if verdict == WRONG:  # p_pos <= p_neg
        return c * 2, c * 2 + 1
    return (top - c) * 2, (top - c) * 2  # p_pos > p_neg


def _split_bits(code: str, width: str, positive: Column) -> Column:
    """Bits at which this row can be the place where two codes part: 0 for a positive, 1 for a negative."""
    want = F.when(positive, F.lit(0)).otherwise(F.lit(1))
    return F.filter(F.sequence(F.lit(0), col(width) - 1), lambda b: F.getbit(col(code), b) == want)


def count_pairs(coded: DataFrame, keys: Sequence[str], questions: dict[str, dict[str, str]]) -> DataFrame:
    """(keys, question, pairs): positive-negative pairs where every scorer named by the question has its verdict.

    ``wrong`` means the positive does not score higher, ``right`` that it does. Questions of
    one call name equally many scorers and are counted together in one pass. A case enters a
    question when it has a score of every scorer named there.
    """
    keys = list(keys)
    n_dims = {len(q) for q in questions.values()}
    if len(n_dims) != 1:
        raise ValueError("questions of one call must name equally many scorers")
    d = n_dims.pop()
    positive, zero = F.col("y") == 1, F.lit(0).cast("long")
    asked = []
    for name, verdicts in questions.items():
        fields = [F.lit(name).alias("question")]
        for i, (s, verdict) in enumerate(verdicts.items()):
            a, b = _sides(s, verdict)
            fields += [F.when(positive, a).otherwise(b).alias(f"__d{i}"),
                       F.ceil(F.log2(col(f"__top_{s}") * 2 + 2)).cast("int").alias(f"__w{i}")]
        known = reduce(and_, [col(s).isNotNull() for s in verdicts])
        asked.append(F.when(known, F.struct(*fields)))
    rows = coded.where(col("y").isin(0.0, 1.0)).select(*cols(keys), "y", F.explode(F.array_compact(F.array(*asked))).alias("q")).select(
        *cols(keys), "y", "q.*")
    # cases alike in every code are one row before any row is repeated per bit
    rows = rows.groupBy(*cols(rows.columns)).agg(F.count(F.lit(1)).alias("__cases"))
    nodes = [*keys, "question"]
    for i in range(d - 1):
        level = f"__d{i}_bit"
        rows = rows.withColumn(level, F.explode(_split_bits(f"__d{i}", f"__w{i}", positive))).withColumn(
            f"__d{i}", F.call_function("shiftright", col(f"__d{i}"), col(level) + 1))
        nodes += [level, f"__d{i}"]
    # "positive code < negative code" is "negative below positive" after a sign flip; at equal codes the
    # negative is put above, so an equality counts nothing
    score = -col(f"__d{d - 1}") * 2 + F.when(positive, 0).otherwise(1)
    hist = rows.groupBy(*cols(nodes), score.alias("score")).agg(
        F.sum(F.when(positive, F.col("__cases")).otherwise(zero)).alias("pos"),
        F.sum(F.when(positive, zero).otherwise(F.col("__cases"))).alias("neg"), F.sum("__cases").alias("n"))
    wins = histogram_auc(hist, nodes)
    return wins.groupBy(*cols(keys), "question").agg(F.sum("wins").cast("long").alias("pairs"))


def component_comparison(wide: DataFrame, keys: Sequence[str], reference: str, components: Sequence[str]) -> DataFrame:
    """Per component: reference errors it corrects and reference-correct pairs it breaks.

    The row named ``*`` counts the pairs every component gets wrong.
    """
    keys = list(keys)
    rows = wide.select(*cols(keys), "y", *cols([reference, *components])).where(col("y").isin(0.0, 1.0))
    coded = pin(dense_codes(rows, keys, [reference, *components]))  # read by both counts below
    two = {f"{kind}:{c}": {reference: ref, c: own} for c in components
           for kind, ref, own in (("corrected", WRONG, RIGHT), ("broken", RIGHT, WRONG))}
    pairs = count_pairs(coded, keys, two)
    kind, name = F.split_part("question", F.lit(":"), F.lit(1)), F.split_part("question", F.lit(":"), F.lit(2))
    each = pairs.groupBy(*cols(keys), name.alias("component")).agg(
        F.coalesce(F.sum(F.when(kind == "corrected", F.col("pairs"))), F.lit(0)).alias("corrected"),
        F.coalesce(F.sum(F.when(kind == "broken", F.col("pairs"))), F.lit(0)).alias("broken"))
    every = count_pairs(coded, keys, {"*": {c: WRONG for c in components}})
    grid = coded.select(*cols(keys)).distinct().withColumn(
        "component", F.explode(F.array(*[F.lit(c) for c in [*components, "*"]])))
    zero = F.lit(0).cast("long")
    all_wrong = every.select(*cols(keys), F.col("question").alias("component"), F.col("pairs").alias("all_wrong"))
    out = join_on(join_on(grid, each, [*keys, "component"], "left"), all_wrong, [*keys, "component"], "left")
    star = col("component") == "*"
    return out.select(
        *cols(keys), "component", F.when(~star, F.coalesce("corrected", zero)).alias("corrected"),
        F.when(~star, F.coalesce("broken", zero)).alias("broken"), F.when(star, F.coalesce("all_wrong", zero)).alias("all_wrong"))
