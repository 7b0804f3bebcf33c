"""spark-submit launcher for the command line (``spark-submit scripts/run_daily.py run …``)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from labormart.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
