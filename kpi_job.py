"""spark-submit entry of the KPI job; see ``--help``."""

import sys

from farelight.job import main

if __name__ == "__main__":
    sys.exit(main())
