"""spark-submit driver for the load job (MRG-7).

    spark-submit --py-files portal_metrics.zip scripts/load.py \
        --fact f.csv --inventory p.csv [--employee e.csv] --out <store root> [--full-refresh] [--no-parquet]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from portal_metrics.plans.load_job import main  # noqa: E402

if __name__ == "__main__":
    main()
