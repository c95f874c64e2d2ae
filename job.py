"""Launcher for the recurring job (see newsbeam/jobs.py).

    spark-submit --py-files newsbeam.zip job.py ingest --pages P --store S
    spark-submit --py-files newsbeam.zip job.py score  --store S --snapshots N
    spark-submit --py-files newsbeam.zip job.py run    --landing L --store S --snapshots N --checkpoint C
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from newsbeam.jobs import main  # noqa: E402

if __name__ == "__main__":
    main()
