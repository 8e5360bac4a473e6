"""Times headline queries on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints one line of JSON.

Every query runs twice, planning and fitting included, into a sink that takes all rows and keeps none. ``queries``
holds the second (warm) times, ``cold`` the first; ``value`` is the sum of the warm ones.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tablelearn.plans import QUERIES
from tablelearn.session import local_session

HEADLINE = [
    "naive_bayes_confusion",
    "infer_and_cast",
    "numeric_profile",
    "quantiles_by_narrowing",
    "categorical_profile",
    "top_values",
    "fill_median",
    "select_rows_slice",
    "add_rows_scattered",
    "join_columns",
    "positional_by_file",
    "full_shuffle",
    "box_shuffle",
    "epoch_plan",
    "train_test_split_train",
    "cross_val_folds",
    "scale_standardize",
    "one_hot",
    "ordinal",
    "ordinal_large_dictionary",
    "confusion_matrix",
    "scores_by_group",
    "linear_two_targets",
    "linear_descent",
    "logistic_classifier",
    "naive_bayes_predict",
    "knn_classifier",
    "nearest_neighbours_pruned",
    "best_split",
    "tree_predict",
    "lvq_train",
    "evaluate_folds_linear",
    "evaluate_folds_bayes",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").collect()
    cold, warm = {}, {}
    for times in (cold, warm):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
