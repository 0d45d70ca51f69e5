"""spark-submit entry of the word count; see ``--help``."""

import sys

from farelight.job import word_count_main

if __name__ == "__main__":
    sys.exit(word_count_main())
