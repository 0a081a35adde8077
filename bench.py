"""Headline stages on the driver's tables; prints one JSON line.

Stages run in the order of the business pipeline and hand stored tables to each other, as a
nightly run would: provider and company tables, grouping matrix, recommendations,
capacity-limited assignment, KPIs, saturation, scenario comparison. Each figure is the time
to compute and store (or fully evaluate) that stage alone.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from matchwright.operators import forest as OF  # noqa: E402
from matchwright.operators import ranks as N  # noqa: E402
from matchwright.operators.matching import assign_capacitated  # noqa: E402
from matchwright.plans import eda  # noqa: E402
from matchwright.plans import grouping as G  # noqa: E402
from matchwright.plans import kpis as P  # noqa: E402
from matchwright.plans import provider_features as PF  # noqa: E402
from matchwright.plans import recommend as R  # noqa: E402
from matchwright.plans.company_features import company_table  # noqa: E402
from matchwright.plans import silver as S  # noqa: E402
from matchwright.session import build_session, scratch_path, stage  # noqa: E402
from workload.views import Tables, narrow  # noqa: E402


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, root)
    times: dict[str, float] = {}

    def timed(name, build, keep=True):
        start = time.perf_counter()
        df = build()
        if keep:
            out = stage(df, name)
        else:
            df.write.format("noop").mode("overwrite").save()
            out = df
        times[name] = round(time.perf_counter() - start, 3)
        return out

    timed("warm_up", lambda: t.table("lineitem"), keep=False)
    # inputs laid out in several files, as any large table is
    visits, orders, catalog, raw = (
        stage(x.repartition(int(cpus)), n)
        for x, n in ((t.visits, "v"), (t.orders, "o"), (t.catalog, "c"), (t.view("fx_raw_ordenado"), "raw"))
    )
    companies, clusters, master = t.companies, t.clusters, t.master

    timed("silver_ordenado", lambda: narrow(S.clean_orders, raw, (S.ORDER_DATES, S.ORDER_AMOUNTS, S.ORDER_FLAGS)), keep=False)
    providers = timed("feat_provider", lambda: PF.provider_table(catalog, master, visits, orders, companies))
    timed("feat_company", lambda: company_table(companies, orders, visits))
    matrix = timed("clustering_input", lambda: PF.grouping_matrix(providers))
    top10 = timed("recommend_top10", lambda: R.recommend(orders, catalog, providers, matrix, clusters))
    first = R.assignments(top10)
    capped = timed("assign_capacitated", lambda: assign_capacitated(top10))
    timed("contribution_shares", lambda: R.enrich(top10), keep=False)
    timed("kpis_summary", lambda: P.kpis_summary(orders, {"rule_based": first, "lp_optimized": capped}, providers), False)
    timed(
        "saturation_index",
        lambda: P.saturation_index({"rule_based": first, "lp_optimized": capped}, clusters, providers),
        False,
    )
    timed("scenario_diff", lambda: P.scenario_diff(first, capped, providers), False)
    timed("scenario_diff_by_cluster", lambda: P.scenario_diff_by_cluster(first, capped, providers), False)
    timed("agg_gini", lambda: N.gini(eda.loads_by_provider(orders), "n_ordenes"), False)
    eligible = stage(R.eligible_providers(providers, matrix, clusters), "eligible")
    timed("score_one_order", lambda: R.score_one_order(catalog, eligible, "T11", "1111.0", segment="GRAN EMPRESA"), False)
    index = R.store_serving_index(R.serving_index(catalog, eligible), scratch_path(spark, "serving"))
    index.score("T11", "1111.0", segment="GRAN EMPRESA").collect()
    timed("serve_one_order", lambda: index.score("T11", "1111.0", segment="GRAN EMPRESA"), False)
    prepared = stage(G.model_matrix(matrix).select(G.WHO, *G.FEATURES), "prepared")
    timed("outlier_quarantine", lambda: OF.outlier_quarantine(prepared, G.WHO, G.FEATURES), False)
    timed("clustering_fit", lambda: G.fit_grouping(matrix, min_size=20, min_kept=2)[1], False)
    times.pop("warm_up")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_total", "value": total, "unit": "sec", "queries": times, "sf": root.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
