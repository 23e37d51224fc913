"""Write docs/PLANS.md: the physical operators (exchanges, sorts, windows,
aggregates, joins, scans) of a few key queries, from ``explain()`` output."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = re.compile(r"(Exchange|Sort |Window|HashAggregate|Join|Scan parquet|InMemoryTableScan|WindowGroupLimit|"
                  r"TakeOrderedAndProject|Expand|Generate|Subquery|BroadcastExchange|Filter|Union)")


def condensed(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = []
    for line in plan.split("\n"):
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            out.append(line[:170])
    return out


def main() -> None:
    from dailyseries.operators import metrics as mt
    from dailyseries.operators import windows as win
    from dailyseries.plans import fixtures as fx
    from dailyseries.plans.halo import window_for_range
    from dailyseries.plans.pipeline import build_features
    from dailyseries.plans.ranking import exact_quantiles
    from dailyseries.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    sf = "/root/testdata/sf0.01"
    cases = {
        "Feature stage of the flagship pipeline (R6): one exchange on series_key, one sort, two windows":
            build_features(fx.daily_weather(spark, sf, nulls=True))[0],
        "ROC AUC (G1): distinct scores, value buckets, per-bucket windows, small offset join":
            mt.roc_auc(fx.scored(spark, sf)),
        "Exact percentiles (A9/G10): order statistics from a bucketed running count":
            exact_quantiles(fx.scored(spark, sf), "p", [0.25, 0.5, 0.99]),
        "Date-range request with halo (X1): per-series top-k (WindowGroupLimit), then the window":
            window_for_range(fx.daily_weather(spark, sf), win.rolling_precip_cols, "1996-01-01", "1996-12-31", back=29),
        "Date range on the scan (S4): bound pushed into the parquet reader":
            fx.daily_weather(spark, sf, start="1996-01-01", end="1996-12-31"),
    }
    lines = ["# Physical plans of key queries", "",
             "Condensed from `explain()` (local[8], sf0.01, AQE initial plan); `scripts/plan_summary.py` regenerates it. "
             "A `SinglePartition` exchange below only ever carries a per-bucket total table (one row per value "
             "bucket) or the partial results of a final one-row aggregate, never the data rows.", ""]
    for title, df in cases.items():
        lines += [f"## {title}", "", "```"] + condensed(df) + ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
