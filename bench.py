"""Times the headline queries and prints one JSON line.

The ``tune_*`` entries run the published grids with 3 folds on the customer table (19
features, 45 vector slots); the others run registered queries and write to a null sink.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators import split as sp, training as tr  # noqa: E402
from tidemark.plans.catalog import load  # noqa: E402
from tidemark.plans.views import customers  # noqa: E402
from tidemark.session import get_spark  # noqa: E402
from tidemark.spec import CUSTOMER  # noqa: E402

QUERIES = [
    "clean_customers", "exploration_summary", "describe_numeric", "missing_counts", "class_distribution",
    "validate_rows", "score_batch", "confusion_matrix", "classification_metrics", "auc_roc", "roc_curve",
    "supplier_runs", "category_index", "standardize", "champion", "promote", "compare_versions", "request_rate",
    "latency_quantiles", "bucket_increase", "histogram_quantile", "drift_report", "distribution_shift", "progress",
    "stream_counts", "stream_rate", "train_lr",
]


def tune(spark, sf: str, algorithm: str) -> float:
    """Seconds to tune one algorithm over its whole grid and refit it, on a cached training side."""
    rows = customers(spark, sf).where("TotalCharges IS NOT NULL")
    train, _ = sp.split(rows, 0.8, 42, CUSTOMER.key)
    with sp.cached(train) as (kept,):
        kept.count()
        start = time.time()
        tr.tune(kept, CUSTOMER, tr.algorithms()[algorithm], partitions=1)
        return time.time() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = get_spark("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = load()
    spark.range(1000).selectExpr("sum(id)").collect()
    only = sys.argv[1:]
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in [*QUERIES, "tune_lr", "tune_rf", "tune_gbt"]:
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name.startswith("tune_"):
                spent = tune(spark, sf, name.removeprefix("tune_"))
            else:
                queries[name](spark, sf).write.format("noop").mode("overwrite").save()
                spent = time.time() - start
        except Exception as error:  # the other timings are worth having; the entry is named in the result
            errors[name] = f"{type(error).__name__}: {error}"[:300]
            print(name, "failed:", errors[name], file=sys.stderr, flush=True)
            continue
        times[name] = round(spent, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                      **({"errors": errors} if errors else {})}))


if __name__ == "__main__":
    main()
