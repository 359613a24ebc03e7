import json
import os
import subprocess
import sys

from conftest import SF_SMALL

HERE = os.path.dirname(os.path.abspath(__file__))
REPO = os.path.dirname(HERE)


def _run(mode):
    out = subprocess.run([sys.executable, os.path.join(HERE, "retry_job.py"), REPO, mode, SF_SMALL],
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_same_result_when_tasks_fail_and_retry():
    clean, injected = _run("clean"), _run("inject")
    assert clean["n"] > 0 and clean == injected
