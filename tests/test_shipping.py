"""The package runs from a folder that does not hold it, without a path to it in the workers."""

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
print("ROWS", entry.queries()["recommend_all_flat"](spark, {SMALL!r}).count())
"""


def test_runs_from_an_empty_folder(tmp_path):
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS" in run.stdout, run.stderr[-2000:]
