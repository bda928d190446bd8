"""The catalog's shape, and a cross-section of it against DuckDB on the smallest tables."""

from pathlib import Path

import pytest

import catalog

catalog.load()
SMALL = Path("/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def test_every_inventory_item_has_a_query():
    root = Path(__file__).resolve().parents[1]
    ids = [line.split("|")[1].strip().lower() for line in (root / "COVERAGE.md").read_text().splitlines() if line.startswith("| ") and "---" not in line][1:]
    assert len(ids) > 150
    assert not [i for i in ids if not any(q.startswith(f"{i}_") for q in catalog.QUERIES)]
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


@pytest.mark.skipif(not SMALL.exists(), reason="driver tables not mounted")
@pytest.mark.parametrize("name", ["c2_gold_override", "d6_masked_auc", "d17_subgroup_auc", "d32_conditional_weights", "e3_rank_blend", "e16_group_folds",
                                  "h8_validation_errors", "k8_pseudo_label_violations", "p14_extraction_batch"])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, str(SMALL))
    cols = sorted(df.columns)
    cur = con.execute(catalog.ORACLES[name])
    names = [c[0] for c in cur.description]
    want = sorted((tuple(r[names.index(c)] for c in cols) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    assert got == want and got
