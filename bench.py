"""Headline queries on local Spark; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Each query runs once to
warm up and is then timed once; BENCH_QUERIES (comma separated) narrows them.
"""

import json
import os
import sys
import time

from opsmill.plans import catalogue
from opsmill.session import build_session

HEADLINE = (
    "cln_clean_customers", "cln_clean_orders", "cln_13_orphan_keys", "cln_14_audit_orders",
    "fea_5_customer_features", "fea_11_restock_flag", "sum_4_orders",
    "qry_5_return_rates", "qry_7_last_order", "qry_10_value_by_tier", "qry_12_restock_plan",
    "pol_6_return_abuse", "pol_12_claim_red_flags", "pol_19_damage_cost", "pol_24_promised_range",
    "pol_27_carrier_scorecard", "pol_33_decision_trace", "cat_2_order_conflicts", "cat_2_customer_conflicts",
    "cat_5_routine_gaps", "doc_3_fixed_chunks", "doc_4_recursive_chunks", "doc_5_semantic_percentile",
    "emb_1_embed_documents", "ret_1_nearest_chunks", "ret_2_keyword_search", "ret_3_hybrid_search", "evl_4_accuracy",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run = catalogue.QUERIES_BY_NAME[name]
        for _ in range(2):
            start = time.time()
            run(spark, root).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total query time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(root.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
