"""Failed task attempts while landing and writing leave exact results.

Runs tools/retry_check.py in its own process (it needs a SparkContext that
retries tasks: local[4,4]).
"""

import json
import subprocess
import sys
from pathlib import Path

TOOL = Path(__file__).resolve().parents[1] / "tools" / "retry_check.py"


def test_retried_tasks_leave_exact_tables():
    proc = subprocess.run([sys.executable, str(TOOL), "/root/testdata/sf0.001"],
                          capture_output=True, text=True, timeout=600)
    result = json.loads(proc.stdout.strip().splitlines()[-1])
    assert proc.returncode == 0, result
    assert result["failed_attempts"] > 0
    assert result["missing"] == 0 and result["extra"] == 0
    assert result["rows_in"] == result["rows_out"]
