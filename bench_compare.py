"""Our plans against the plain forms of the same work, on the CSV files of ``$BENCH_SF_DIR``.

``COMPARE_COPIES`` repeats every source row under other order ids, ``COMPARE_HOT=1`` gives a
third of all rows one key. Prints one JSON line of median seconds per form.
"""

from __future__ import annotations

import json
import os
import statistics

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bench import session, timed
from tillroll import fixtures
from tillroll.operators import cleansing, profiling
from tillroll.plans import loads, reports
from tillroll.schema import KEYS, ORDER_ID, QUANTITY, SOURCE_SCHEMA
from tillroll.sinks.tables import write_table
from tillroll.sources.files import csv_scan
from tillroll.sources.tables import read_table
from tillroll.storage import scratch_path, stored_scratch


def plain_dedup(df: DataFrame) -> DataFrame:
    """Top row per key as the maximum of a struct that begins with the quantity."""
    rest = [c for c in df.columns if c not in KEYS and c != QUANTITY]
    best = F.max(F.struct(QUANTITY, *rest)).alias("best")
    return df.groupBy(*KEYS).agg(best).select(*KEYS, "best.*")


def plain_batch(spark: SparkSession, folder: str, path: str) -> None:
    """One scan of the folder with inferred types, cleansed and written as it lies."""
    scanned = csv_scan(spark, folder, schema=None).transform(cleansing.remove_nulls)
    cleansed = (
        plain_dedup(scanned)
        .transform(cleansing.parse_dates)
        .transform(cleansing.add_period)
        .transform(cleansing.rename_columns)
    )
    write_table(cleansed, path, layout="as_is")


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("COMPARE_COPIES", "1"))
    hot = os.environ.get("COMPARE_HOT") == "1"
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))

    source = fixtures.sales(spark, sf_dir).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    )
    source = source.withColumn(ORDER_ID, F.col(ORDER_ID) * copies + F.col("copy"))
    if hot:
        is_hot = F.xxhash64(*SOURCE_SCHEMA.fieldNames()) % 3 == 0
        for name, value in zip(KEYS, (0, "hot"), strict=True):
            source = source.withColumn(name, F.when(is_hot, value).otherwise(F.col(name)))
    folder = scratch_path(spark, "compare-csv")
    source.select(*SOURCE_SCHEMA.fieldNames()).repartition(16).write.option("header", True).csv(folder)
    rows = stored_scratch(cleansing.remove_nulls(spark.read.schema(SOURCE_SCHEMA).csv(folder, header=True)), "rows")
    cleansed = stored_scratch(cleansing.cleanse(rows), "cleansed")
    table = scratch_path(spark, "table")
    write_table(cleansed, table, layout="clustered")
    reports.keep_totals(spark, table)

    def path() -> str:
        return scratch_path(spark, "out")

    forms = {
        "dedup, ours": lambda: noop(cleansing.remove_duplicates(rows)),
        "dedup, plain": lambda: noop(plain_dedup(rows)),
        "cleanse, ours": lambda: noop(cleansing.cleanse(rows)),
        "cleanse, plain": lambda: noop(
            plain_dedup(rows).transform(cleansing.parse_dates).transform(cleansing.add_period)
        ),
        "batch, header gate": lambda: loads.batch_load(spark, folder, path(), path()),
        "batch, fail gate": lambda: loads.batch_load(spark, folder, path(), path(), gate="fail"),
        "batch, strict gate": lambda: loads.batch_load(spark, folder, path(), path(), gate="strict"),
        "batch, plain": lambda: plain_batch(spark, folder, path()),
        "write, clustered": lambda: write_table(cleansed, path(), layout="clustered"),
        "write, rebalance": lambda: write_table(cleansed, path()),
        "write, as_is": lambda: write_table(cleansed, path(), layout="as_is"),
        "report, all months": lambda: noop(reports.monthly_report(read_table(spark, table))),
        "report, one month": lambda: noop(
            reports.monthly_report(read_table(spark, table), (2020, 6), (2020, 6))
        ),
        "report, kept totals": lambda: noop(reports.kept_report(spark, table)),
        "top keys, all counts": lambda: noop(profiling.top_dup_keys(rows)),
        "top keys, bounded": lambda: noop(profiling.top_dup_keys_of_stored(rows)),
    }
    seconds = {}
    for name, run in forms.items():
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(repeats)), 2)
    print(json.dumps({"rows": rows.count(), "kept": cleansed.count(), "hot": hot, "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
