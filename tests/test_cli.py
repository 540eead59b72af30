"""The command line runs the replay end to end (own process: it stops its session)."""

import json
import subprocess
import sys

from conftest import REPO, SF_SMALL


def test_cli_replay_reconciles():
    out = subprocess.run(
        [sys.executable, "-m", "lateflow", "--master", "local[2]", "replay", "--events",
         SF_SMALL], cwd=REPO, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    summary = json.loads(out.stdout[out.stdout.index("{"):])
    assert summary["reconciles"] and summary["micro_batches"] == 838
