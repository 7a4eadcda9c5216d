"""Run the headline queries once each and print one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from sparkkit.queries import load

HEADLINE = (
    "market_basket", "frequent_itemsets", "pearson", "spearman", "kendall", "correlation_matrix", "pack_features", "parse_number",
    "scale_standard", "scale_robust", "one_hot", "count_vectorize", "tf_idf", "add_lags", "running_count", "neighbour_context",
    "range_join_counts", "pivot_measures", "classifier_metrics", "regressor_metrics", "kfold_stratified", "profile_features",
    "linear_regression", "ridge_cv", "gaussian_nb", "k_neighbours_classifier", "forecast_trend", "forecast_seasonal",
    "holiday_terms", "extract_patterns", "align_annotations", "dbscan", "pca", "predict", "predict_sequence", "windowed_stats",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g")).config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    registry = load()
    spark.read.parquet(f"{folder}/orders.parquet").count()
    times = {}
    for name in HEADLINE:
        if name not in registry:
            continue
        start = time.time()
        registry[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        spark.catalog.clearCache()
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(folder)}))


if __name__ == "__main__":
    main()
