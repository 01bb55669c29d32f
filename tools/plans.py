"""Print the physical plans of the key builders (used to write PLANS.md).

usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vaultmart.operators import ods as ods_ops  # noqa: E402
from vaultmart.operators import report_mart as rm  # noqa: E402
from vaultmart.operators import vault  # noqa: E402
from vaultmart.plans import params as P  # noqa: E402
from vaultmart.plans import pipeline  # noqa: E402
from vaultmart.plans.catalog import PAYMENT_VAULT, QUERIES, Vault, stg  # noqa: E402
from vaultmart.plans.specs import MEASURE_BY_LINK, SAT_BY_NAME  # noqa: E402
from vaultmart.session import build_session, scratch_folder  # noqa: E402
from vaultmart.sources import tables  # noqa: E402


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"file:/\S+", "<path>", text)
    return "\n".join(line[:180] for line in text.splitlines())


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    out = []

    staged = tempfile.mkdtemp(prefix="vaultmart-plans-") + "/stg_traffic"
    stg(spark, sf_dir).traffic.write.parquet(staged)
    s = tables.read_stg(spark, staged, "traffic")
    out.append(("ODS traffic slice from a stored staging table (year range pushed to the scan)",
                plan(ods_ops.ods_slice(s, "traffic", P.SLICE_YEAR))))
    out.append(("Q2 top users (pruned scan, partial aggregate, TakeOrderedAndProject)",
                plan(QUERIES["top_users"](spark, sf_dir))))
    v = Vault(spark, sf_dir)
    out.append(("Hub load from two feeds (hash pre-aggregation, then min of a struct per key)",
                plan(v.hub("user"))))
    out.append(("Link load (min of a struct per key, combined map-side)",
                plan(v.link("billing"))))
    # a stored vault of two runs, read as the next run and the mart read it
    root = scratch_folder(spark) + "/vault"
    fixtures = stg(spark, sf_dir)
    for year in (1996, 1997):
        pipeline.run_vault_year(fixtures, root, year, PAYMENT_VAULT | {"sat_user"})
    batch = v.hashed("payment").where("year(load_dts) = 1998")
    user = SAT_BY_NAME["user"]
    current = spark.read.parquet(f"{root}/dds_c_sat_user/run=1997")
    out.append(("Satellite load that follows the newest run (current versions only, no history)",
                plan(vault.satellite_delta(batch, user, None, ods_ops.load_date(1998), current))))
    m = MEASURE_BY_LINK["payment"]
    view = pipeline.read_vault(spark, root, (m,))
    out.append(("Report aggregate of one year on the stored vault (one year of the links, no exchange between link and satellite)",
                plan(rm.report_aggregate(view, m, P.SLICE_YEAR))))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out.append(("All measures in one pass (facts as one union, hub and master data joined once)",
                plan(rm.report_totals(v.view()))))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    _, fact = rm.marts_backfill(Vault(spark, sf_dir).view())
    out.append(("Dense fact (grid from a range, one join on the cell number)", plan(fact)))
    for title, text in out:
        print(f"### {title}\n\n```\n{text}\n```\n")


if __name__ == "__main__":
    main()
