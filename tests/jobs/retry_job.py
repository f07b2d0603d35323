"""Run operators while the first attempt of some tasks fails; print results as JSON.

Started by tests/test_retries.py in its own process, since the master
(``local[4,3]``: up to 3 attempts per task) is fixed per JVM.
"""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from foldline.operators import box_stats, consolidate, histogram  # noqa: E402
from foldline.session import build_session  # noqa: E402


def flaky(value):
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected failure on a first attempt")
    return value


def main() -> None:
    spark = build_session(
        "local[4,3]",
        shuffle_partitions=6,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="foldline-retry-")},
    )
    orders = spark.read.parquet(sys.argv[1]).select("o_orderpriority", "o_totalprice", "o_orderstatus")
    orders = orders.repartition(4)
    if sys.argv[2] == "flaky":
        udf = F.udf(flaky, "double")
        orders = orders.withColumn("o_totalprice", udf("o_totalprice"))
    box = box_stats(orders, "o_totalprice", "o_orderpriority").collect()
    folded = consolidate(orders.select("o_orderpriority", "o_orderstatus")).collect()
    hist = histogram(orders, "o_totalprice", bins=8).collect()
    print(json.dumps({
        "box": sorted([list(r) for r in box]),
        "folded": sorted([list(r) for r in folded]),
        "hist": sorted([list(r) for r in hist]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
