"""Deterministic hashes and draws, written so that any SQL engine can repeat them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.scale import col, cols


def sha256_text(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def uniform60(*parts: Column | str | int) -> Column:
    """First 60 bits of sha256 over the colon-joined parts, as a long in [0, 2**60)."""
    joined = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 15), 16, 10).cast("long")


def canonical_json(fields: dict[str, Column]) -> Column:
    """Compact JSON object with keys in alphabetical order; null fields are kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def canonical_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(canonical_json(fields), 256)


def resume_key(uid: Column, report: Column, model: Column, revision: Column, prompt_hash: Column,
               ontology: Column, evidence_policy: Column) -> Column:
    """Key under which an extraction result may be reused."""
    return canonical_hash({
        "uid": uid, "report_hash": sha256_text(report), "model": model, "revision": revision,
        "prompt_hash": prompt_hash, "ontology": ontology, "evidence_policy": evidence_policy,
    })


def row_digest(columns: Sequence[str]) -> Column:
    """sha256 of a row's cells, each with its length in front, so that no two rows of different cells hash the same bytes."""
    cells = [F.coalesce(F.concat(F.length(col(c).cast("string")).cast("string"), F.lit(":"), col(c).cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*cells), 256)


def table_fingerprint(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Order-independent content hash of a table, or of each group: (group, n_rows, fingerprint).

    Every row is hashed with sha256; the four 64-bit words of the hashes are summed and the
    count and sums are hashed. A repeated row counts as often as it occurs. Sums merge on the
    map side, so no rows are moved and nothing is collected, however long the table is.
    """
    return _summed(df.select(*cols(group), row_digest(columns).alias("h")), group)


def _summed(hashed: DataFrame, group: Sequence[str]) -> DataFrame:
    words = [F.conv(F.substring("h", i, 16), 16, 10).cast("decimal(28,0)") for i in (1, 17, 33, 49)]  # sums have 38 digits
    sums = [F.coalesce(F.sum(w), F.lit(0)).cast("string") for w in words]
    n = F.count(F.lit(1))
    return hashed.groupBy(*cols(group)).agg(n.alias("n_rows"), F.sha2(F.concat_ws(":", n.cast("string"), *sums), 256).alias("fingerprint"))


def range_fingerprints(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """(range, n_rows, fingerprint) of the rows whose digests begin with the same hexadecimal digits: 16 ** digits ranges at most."""
    hashed = df.select(row_digest(columns).alias("h"))
    return _summed(hashed.select(F.substring("h", 1, digits).alias("range"), "h"), ["range"])


def differing_ranges(left: DataFrame, right: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """(range, n_left, n_right) where two tables differ; what they hold there is found by filtering both on the range."""
    a, b = (range_fingerprints(x, columns, digits).withColumnsRenamed({"n_rows": f"n_{side}", "fingerprint": side}) for x, side in ((left, "left"), (right, "right")))
    both = a.join(b, "range", "full_outer").where(~F.col("left").eqNullSafe(F.col("right")))
    return both.select("range", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("n_left", "n_right")])


def id_list_fingerprint(df: DataFrame, id_col: str, group: Sequence[str] = ()) -> DataFrame:
    """(group, n_ids, ids_sha256): ``table_fingerprint`` of the ids alone, for lists of any length."""
    return table_fingerprint(df, [id_col], group).withColumnsRenamed({"n_rows": "n_ids", "fingerprint": "ids_sha256"})
