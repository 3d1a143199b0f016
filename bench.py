"""Time the headline queries and print one JSON line.

Each query writes its whole result to Spark's no-op sink, so nothing is collected and no column is
pruned away. The median of the timed runs counts; the first run, which warms the JVM, does not. A query
whose first run takes longer than LONG_SECONDS is timed once more only.
"""

from __future__ import annotations

import importlib
import json
import os
import statistics
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
LONG_SECONDS = 8


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(query, spark: SparkSession) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def rule_set_seconds(spark: SparkSession) -> dict[str, float]:
    """The rules of one entity in one pass, against one scan and one set of joins per rule."""
    from dataclasses import replace

    from veriledger.operators.ruleset import RuleSet, evaluate
    from veriledger.plans import catalogue_queries as q
    from veriledger.specs.account import CACD_MONTHLY
    from veriledger.specs.codes import sample_codes

    whole = CACD_MONTHLY.passes[0]
    single = [
        RuleSet(CACD_MONTHLY.entity, (replace(
            whole, rules=(rule,), lookups=tuple(l for l in whole.lookups if l.name in rule.needs)),))
        for rule in whole.rules
    ]

    def run(rule_sets):
        def query(spark, sf_dir):
            from functools import reduce

            from pyspark.sql import DataFrame

            tables = q.entities(spark, sf_dir, CACD_MONTHLY.reads)
            return reduce(DataFrame.unionByName, [
                evaluate(tables, r, q.PERIOD, sample_codes()) for r in rule_sets])
        timed(query, spark)
        return round(statistics.median(timed(query, spark) for _ in range(RUNS)), 3)

    return {"rules": len(single), "one_pass": run([CACD_MONTHLY]), "one_scan_per_rule": run(single)}


def main() -> None:
    spark = session()
    queries = importlib.import_module("__spark_entry__").queries()
    seconds = {}
    for name, query in queries.items():
        runs = 1 if timed(query, spark) > LONG_SECONDS else RUNS
        seconds[name] = round(statistics.median(timed(query, spark) for _ in range(runs)), 4)
    rule_set = rule_set_seconds(spark)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rule_set": rule_set,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
