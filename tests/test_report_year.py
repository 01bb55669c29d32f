"""The facts of one report year from the stored vault."""

from collections import Counter

import pytest

from vaultmart.operators import report_mart as rm
from vaultmart.plans import pipeline
from vaultmart.plans.specs import MEASURE_BY_LINK

from test_dealt_once import final_plan, loaded  # noqa: F401


@pytest.mark.parametrize("name", ["payment", "billing", "issue"])
def test_report_year_sorts_no_satellite(spark, loaded, name):
    """The facts of a report year: the satellite passes by unsorted, and the sums are those of a plain join."""
    m = MEASURE_BY_LINK[name]
    view = pipeline.read_vault(spark, loaded, (m,))
    plain = rm.VaultView(view.hub_user, view.hub_billing_period, {name: view.links[name].drop("link_year")}, {name: view.sats[name].drop("year")}, view.sat_user_mdm)
    total = 0
    for year in (2013, 2014):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            facts = rm._facts(view, m, year, "report_year")
            assert "SortMergeJoin" not in final_plan(facts)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        want = rm._facts(plain, m, year, "report_year").collect()
        assert Counter(facts.collect()) == Counter(want)
        total += len(want)
    assert total
