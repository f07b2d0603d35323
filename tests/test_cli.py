"""The command line, each command in its own process (as a user runs it)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _cli(*args):
    out = subprocess.run(
        [sys.executable, "-m", "foldline", "--master", "local[2]", *args],
        cwd=REPO, capture_output=True, text=True, timeout=600,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_land_flow_then_describe_in_new_processes(tmp_dir):
    src = os.path.join(tmp_dir, "src", "samples.csv")
    os.makedirs(os.path.dirname(src))
    with open(src, "w") as handle:
        handle.write("5.1,3.5,kind-a\n5.1,3.5,kind-a\n4.9,3.0,kind-a\n7.0,3.2,kind-b\n")
    landed = _cli("land", src, os.path.join(tmp_dir, "in"), "--names", "length,width,kind").strip()
    wh = os.path.join(tmp_dir, "wh")
    out = _cli("flow", landed, "samples.csv", os.path.join(tmp_dir, "out"), "--database", "cli_db",
               "--table", "samples", "--warehouse", wh, "--filter-column", "kind", "--filter-value", "kind-a")
    assert os.path.isdir(os.path.join(tmp_dir, "out", "transformed_samples.csv"))
    assert "Data (2 rows):" in out
    shown = _cli("show-table", "cli_db", "samples", "--warehouse", wh)
    assert "occurrences" in shown and "cli_db" in shown
    hist = _cli("histogram", "cli_db", "samples", "length", "--warehouse", wh, "--bins", "2")
    assert "Data (2 rows):" in hist
    box = _cli("boxplot", "cli_db", "samples", "length", "--warehouse", wh)
    assert "whisker_low" in box
    printed = _cli("print", os.path.join(tmp_dir, "out", "transformed_samples.csv"))
    assert "Data (2 rows):" in printed
