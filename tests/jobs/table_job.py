"""One process of its own, with its own catalog, that overwrites, appends to or counts a stored table.

Started by tests/test_versions.py: ``table_job.py <warehouse> <database> <table> <step>...`` with
steps ``overwrite:<first>:<rows>``, ``append:<first>:<rows>`` and ``count``; prints the counts.
"""

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from foldline.session import build_session  # noqa: E402
from foldline.sinks import save_table  # noqa: E402
from foldline.sources import attach_table  # noqa: E402


def main() -> None:
    warehouse, database, table, *steps = sys.argv[1:]
    spark = build_session("local[2]", shuffle_partitions=2, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="foldline-job-")})
    counts = []
    for step in steps:
        action, _, bounds = step.partition(":")
        if action == "count":
            counts.append(attach_table(spark, database, table, warehouse).count())
            continue
        first, rows = map(int, bounds.split(":"))
        save_table(spark.range(first, first + rows), database, table, warehouse_dir=warehouse, mode=action)
    print("COUNTS", *counts)
    spark.stop()


if __name__ == "__main__":
    main()
