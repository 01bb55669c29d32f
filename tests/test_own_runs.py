"""Queries on the scheduled runs make their own, whatever ran before in the session."""

from vaultmart.plans import catalog, pipeline
from vaultmart.plans.params import RERUN_YEAR

SMALL = "/root/testdata/sf0.001"


def test_every_query_makes_its_own_runs(spark, monkeypatch):
    loads, marts = [], []
    monkeypatch.setattr(pipeline, "run_vault_year", lambda stg, root, year, only: loads.append((root, year)))
    monkeypatch.setattr(pipeline, "run_mart_year", lambda spark, root, year, measures: marts.append((root, year)))
    roots = [catalog._payment_marts(spark, SMALL) for _ in range(2)] + [catalog._loaded_vault(spark, SMALL, catalog.PAYMENT_VAULT)[0]]
    years = [y for _, y in loads if _ == roots[0]]
    assert len(set(roots)) == 3 and years[-1] == RERUN_YEAR and years[:-1] == sorted(set(years))
    assert loads == [(r, y) for r in roots for y in years]
    assert marts == [(r, y) for r in roots[:2] for y in years]
