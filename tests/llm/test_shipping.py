"""Objects in broadcasts reach workers that have no copy of the package."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SMALL

PROGRAM = f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", {str(ROOT / "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from tallymill.session import build_session
spark = build_session("away", master="local[2]", shuffle_partitions=2, settings={{"spark.ui.enabled": "false"}})
for name in ("op10_language", "op13_token_counts"):
    rows = entry.queries()[name](spark, {SMALL!r}).collect()
    print("ROWS", name, len(rows))
"""


def test_models_and_tables_travel_by_value(tmp_path):
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert run.stdout.count("ROWS") == 2, run.stderr[-2000:]
