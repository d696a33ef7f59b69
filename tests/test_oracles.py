"""Every query with an oracle agrees with DuckDB on the sf0.001 tables (names, types, rows, values)."""

from __future__ import annotations

import pytest

from cohortlab.plans import catalog as _catalog
from cohortlab.plans.verify import compare

from cohort_test_tables import SF_SMALL

_catalog.load_all()
ORACLE_KEYS = sorted(_catalog.ORACLES)


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_matches_oracle(spark, duck_small, key):
    res = compare(spark, duck_small, key, SF_SMALL)
    assert res["status"] == "match", res


# a match of empty tables would prove nothing
@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_oracle_has_rows(duck_small, key):
    assert duck_small.execute(f"SELECT count(*) FROM ({_catalog.ORACLES[key]}) q").fetchall()[0][0] > 0


def test_phenotype_label_counts(spark, catalog):
    df = catalog.QUERIES["dm_phenotype"](spark, SF_SMALL)
    counts = {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}
    assert counts == {1: 71, 0: 145, 3: 3}
    both = df.groupBy("subject_id").count().where("count > 1").count()
    assert both == 69


def test_every_query_has_entry(catalog):
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
