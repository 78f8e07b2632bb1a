"""Times the headline work on the tables in $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from telemill import configure, latest, load, parse, start_ingest
from telemill.checks import feeds
from telemill.checks.queries import by_table, fresh
from telemill.operators import coerce, flatten
from telemill.session import scratch_dir
from telemill.sources.raw import read_raw, stream_raw

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def land(spark: SparkSession, raw: DataFrame, purpose: str) -> str:
    """Raw messages as the files a bridge would leave, made outside the timing."""
    path = scratch_dir(spark, purpose)
    raw.repartition(CPUS).write.parquet(path)
    return path


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    objects = land(spark, feeds.raw_obj(spark, FOLDER), "objects")
    lists = land(spark, feeds.raw_list(spark, FOLDER), "lists")
    wide = land(spark, feeds.raw_wide(spark, FOLDER), "wide")
    loaded = fresh(spark, "loaded")
    load(read_raw(spark, objects), "first", loaded)

    def ingest(path: str, staged: bool = False) -> None:
        staging = scratch_dir(spark, "staging") if staged else None
        load(read_raw(spark, path), "bench", fresh(spark, "bench"), staging=staging)

    def stream() -> None:
        raw = stream_raw(spark, objects, max_files_per_trigger=max(CPUS // 2, 1))
        start_ingest(raw, "bench", scratch_dir(spark, "progress"), fresh(spark, "bench")).awaitTermination()

    def coerced() -> None:
        parsed = flatten.accepted(parse(read_raw(spark, objects)), "data")
        for outcomes, columns in by_table(parsed):
            run(coerce.table_cells(outcomes, columns))

    work: dict[str, Callable[[], None]] = {
        "parse_objects": lambda: run(parse(read_raw(spark, objects))),
        "parse_lists": lambda: run(parse(read_raw(spark, lists))),
        "flatten_long": lambda: run(flatten.cells(flatten.rows(flatten.accepted(parse(read_raw(spark, objects)))))),
        "cell_coercion": coerced,
        "ingest_objects": lambda: ingest(objects),
        "ingest_objects_staged": lambda: ingest(objects, staged=True),
        "ingest_lists": lambda: ingest(lists),
        "ingest_stream": stream,
        "parse_wide": lambda: run(parse(read_raw(spark, wide))),
        "ingest_wide": lambda: ingest(wide),
        "latest_n": lambda: run(latest(spark, "telemetry", "error", order="timestamp", options=loaded)),
    }
    seconds = {}
    for name, job in work.items():
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)

    messages = {"ingest_objects": objects, "ingest_objects_staged": objects, "ingest_lists": lists,
                "ingest_stream": objects, "ingest_wide": wide}
    counts = {path: read_raw(spark, path).count() for path in set(messages.values())}
    print(json.dumps({
        "metric": "total time of the headline work",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "messages_per_second": {name: round(counts[path] / seconds[name]) for name, path in messages.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
