"""``python -m strata <job> ...``: see ``strata.plans.cli``."""

import sys

from .plans.cli import main

sys.exit(main())
