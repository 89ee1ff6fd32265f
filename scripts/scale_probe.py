"""Throughput of the core operators on K copies of the sf0.1 events.

Copies are made by Spark with a generator (``explode(sequence(0, K-1))``),
each copy shifted by K-unique event ids and by whole days, so times stay
distinct per symbol. Each operator is forced with a ``noop`` write; the
median of three runs is reported with ticks per second.

Usage: python scripts/scale_probe.py [K] [cpus]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ohlcflow import fixtures  # noqa: E402
from ohlcflow.operators.bars import dedupe_latest, last_n_bars, ohlcv, select_tier, union_tiers  # noqa: E402
from ohlcflow.operators.setops import except_all  # noqa: E402
from ohlcflow.operators.ticks import latest_price  # noqa: E402
from ohlcflow.session import build_session, scratch_path  # noqa: E402


def main() -> None:
    k = int(sys.argv[1]) if len(sys.argv) > 1 else 50
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = build_session("scale-probe", master=f"local[{cpus}]",
                          conf={"spark.sql.shuffle.partitions": str(cpus * 4), "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    ev = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_c")
    big = ev.select("*", copy).select(
        (F.col("event_id") * k + F.col("_c")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.col("_c") * 30)).alias("ts"),
        "user_id", "event_type", "value", "props",
    )
    path = scratch_path(spark, f"events-x{k}")
    big.write.parquet(path)
    ticks = fixtures.ticks(spark.read.parquet(path)).cache()
    n = ticks.count()
    hourly = ohlcv(ticks, "1 hour", tiebreak="event_id")
    ops = {
        "ohlcv_1h": hourly,
        "ohlcv_1m": ohlcv(ticks, "1 minute", tiebreak="event_id"),
        "tiers_3_selected": select_tier(
            union_tiers(*[ohlcv(ticks, e, tiebreak="event_id").withColumn("batch_unit", F.lit(u))
                          for u, e in (("daily", "1 day"), ("hourly", "1 hour"), ("minutely", "1 minute"))]),
            "2025-05-01",
        ),
        "latest_price_by_user": latest_price(ticks, keys=("user_id",), tiebreak="event_id"),
        "last_24_hourly": last_n_bars(hourly, 24),
        "dedupe_ticks": dedupe_latest(ticks.unionByName(ticks), keys=("event_id",), order_col="user_id"),
        "except_all": except_all(ticks.select("user_id", "symbol"), ticks.where("price < 10").select("user_id", "symbol")),
    }
    out = {}
    for name, df in ops.items():
        df.write.format("noop").mode("overwrite").save()
        times = []
        for _ in range(3):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        sec = statistics.median(times)
        out[name] = {"sec": round(sec, 3), "ticks_per_sec": int(n / sec)}
    print(json.dumps({"rows": n, "copies": k, "cpus": cpus, "ops": out}))
    spark.stop()


if __name__ == "__main__":
    main()
