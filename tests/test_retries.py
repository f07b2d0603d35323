"""Results must not change when tasks fail and are retried."""

import json
import os
import subprocess
import sys

JOB = os.path.join(os.path.dirname(os.path.abspath(__file__)), "jobs", "retry_job.py")
ORDERS = "/root/testdata/sf0.001/orders.parquet"


def _run(mode):
    out = subprocess.run(
        [sys.executable, JOB, ORDERS, mode], capture_output=True, text=True, timeout=600, check=True
    )
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_retried_tasks_give_the_same_results():
    clean = _run("clean")
    flaky = _run("flaky")
    assert clean == flaky
    assert len(clean["box"]) == 5 and sum(r[-1] for r in clean["folded"]) == 1500
