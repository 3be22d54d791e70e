"""Failed tasks are retried and the results stay exact (deterministic plans)."""

import os
import subprocess
import sys

SCRIPT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "scripts", "retry_job.py")


def test_offsets_and_quarantine_survive_task_retries():
    out = subprocess.run([sys.executable, SCRIPT], capture_output=True, text=True, timeout=600)
    assert "RETRY-OK" in out.stdout, out.stderr[-3000:]
    # the simulated failures really happened
    assert "simulated lost task" in out.stderr
