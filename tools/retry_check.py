"""Failed task attempts in the middle of landing and of a partitioned write.

Runs in its own process on ``local[4,4]`` (each task may be tried 4 times).
The first attempt of every even-numbered task raises half-way through its
rows, once while landing the records and once while writing the silver table.
The table must equal the input exactly: no lost and no duplicated rows.
Prints one JSON line; exit code 0 when the check holds.
"""

from __future__ import annotations

import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from strata.lake import Lake  # noqa: E402
from strata.operators.silver import conform  # noqa: E402
from strata.operators.tables import ensure_table, write_by_name  # noqa: E402
from strata.session import PIPELINE_CONF, storage_root  # noqa: E402
from strata.sources.landing import land_day, read_day  # noqa: E402


def failing_first_attempt(marker_dir: str):
    """mapInPandas function whose first attempt of even tasks fails mid-way."""

    def run(batches):
        ctx = TaskContext.get()
        first = ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0
        for i, pdf in enumerate(batches):
            if first and i == 1:
                Path(marker_dir, f"{ctx.stageId()}-{ctx.partitionId()}").touch()
                raise RuntimeError("injected task failure")
            yield pdf

    return run


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    builder = (SparkSession.builder.master("local[4,4]").appName("retry-check")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.execution.arrow.maxRecordsPerBatch", "50"))
    for k, v in PIPELINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    storage_root(spark)
    lake = Lake.fresh(spark, "retry_check")
    markers = tempfile.mkdtemp(prefix="run-")
    fail_first_attempt = failing_first_attempt(markers)

    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").repartition(8, "o_orderkey")
    flaky = orders.mapInPandas(fail_first_attempt, orders.schema)
    base = lake.bronze("tpch", "orders")
    land_day(flaky, base, "20240101")

    schema = [(f.name, f.dataType.simpleString()) for f in orders.schema.fields]
    typed = conform(read_day(spark, base, "20240101"), schema, "o_orderstatus")
    typed = typed.mapInPandas(fail_first_attempt, typed.schema)
    table = "retry_check.orders"
    ensure_table(spark, table, schema, "o_orderstatus", lake.location("silver", "retry_check",
                                                                        "orders"))
    write_by_name(typed, table)

    got = spark.table(table).select(*orders.columns)
    missing = orders.exceptAll(got).count()
    extra = got.exceptAll(orders).count()
    failures = len(list(Path(markers).iterdir()))
    result = {"rows_in": orders.count(), "rows_out": got.count(), "missing": missing,
              "extra": extra, "failed_attempts": failures}
    print(json.dumps(result))
    spark.stop()
    return 0 if missing == 0 and extra == 0 and failures > 0 else 1


if __name__ == "__main__":
    raise SystemExit(main())
