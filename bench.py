"""Times headline queries; prints one JSON line."""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

SF_DIR, CPUS = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
HEADLINE = ["standardize_history", "customer_mapping_first", "product_mapping_first", "backfill_products_inventory", "pseudonymize_history", "pseudonymize_open", "pseudonymize_inventory", "mapping_violations_clean", "quality_report_history", "land_authorized"]


COLD = ["pseudonymize_inventory", "mapping_violations_clean"]  # each again with nothing made before it


def main() -> None:
    from sparkveil.plans import registry
    from sparkveil.sources import tables

    spark = SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    registry.history(spark, SF_DIR).count()  # code and files are warm before the clock starts
    times, cold = {}, {}
    for name in HEADLINE:
        began = time.time()
        registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
    for name in COLD:
        tables.release(spark)
        began = time.time()
        registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        cold[name] = round(time.time() - began, 3)
    tables.release(spark)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "cold": cold, "sf": SF_DIR}))
    spark.stop()


if __name__ == "__main__":
    main()
