"""Python worker code does not need the package on the workers' path."""

from __future__ import annotations

import os
import pathlib
import subprocess
import sys
import tempfile

from starmart.plans import queries as Q
from tests.conftest import SF_SMALL

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_queries_run_from_a_folder_without_the_package(spark):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    proc = subprocess.run(
        [sys.executable, str(ROOT / "tests" / "scripts" / "foreign_cwd.py"), str(ROOT), SF_SMALL],
        capture_output=True,
        text=True,
        timeout=600,
        cwd=tempfile.mkdtemp(prefix="starmart-cwd-"),
        env=env,
    )
    line = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, proc.stdout[-2000:] + proc.stderr[-2000:]
    expected = {n: Q.QUERIES[n](spark, SF_SMALL).count() for n in ("label_blocks", "origin_build")}
    assert line[0] == "RESULT " + " ".join(f"{k}={v}" for k, v in sorted(expected.items()))
