"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated ids instead of the headline list, or "all"
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = """
table_scan group_having_limit inner_join_agg star_join rank_over_agg monthly_report numeric_summary quantiles
row_number_dense_lead rolling_features avg_rank impute_median iqr_cap cleaning_steps qcut_bins robust_scale target_encode
select_k_best_f pearson_matrix spearman_matrix ttest_welch anova_oneway chi_square zero_gap_interpolate seasonal_decompose
backtest stratified_split roc_auc classification_report psi ks_two_sample tokenize tfidf cosine_similarity reply_parse
graph_stats pagerank histogram_bins box_stats kde_curve ridge_cv arima_forecast stream_window_agg
""".split()


def main() -> None:
    from tallyframe.plans import registry
    from tallyframe.session import local_session

    registry.load_all()
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(registry.QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()  # warm the session, not the queries
    times = {}
    for n in names:
        t0 = time.perf_counter()
        registry.QUERIES[n](spark, folder).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
        print(n, times[n], file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
