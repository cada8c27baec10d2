"""Script form of ``python -m strata`` for spark-submit (which runs files, not modules).

    spark-submit strata_job.py bronze_to_silver --base DIR --source S --table T
"""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from strata.plans.cli import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
