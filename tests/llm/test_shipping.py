"""Executors need no copy of the package: functions and models travel by value."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from croptide.session import build_session
from croptide.llm.queries import QUERIES
spark = build_session("shipping", 2)
for name in ("op2_token_counts", "op3_language", "op6_substring_dedup", "op9_decontamination",
             "op10_html"):
    QUERIES[name](spark, "/root/testdata/sf0.001").count()
print("all ran")
"""


def test_queries_run_where_workers_cannot_import_the_package(tmp_path):
    repo = str(Path(__file__).resolve().parents[2])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "all ran" in out.stdout, out.stderr[-2000:]
