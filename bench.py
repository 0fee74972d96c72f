"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from tidemark.plans import catalog

HEADLINES = (
    "bars_ohlcv", "base_metrics", "rolling_regr_r2", "momentum_lags", "adjusted_bars", "asof_prior", "ca_decision", "or_key_anti", "interval_join",
    "quarantine_review", "repair_detect", "month_universe", "pit_membership", "weekly_rank", "score_rank", "vol_filter", "anti_missing_sessions", "shape_per_year", "session_windows", "late_drop",
)


def main() -> None:
    cpus, sf_dir = os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    warm = catalog.queries()["bars_ohlcv"](spark, sf_dir)
    warm.write.format("noop").mode("overwrite").save()
    for name in HEADLINES:
        began = time.perf_counter()
        catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
