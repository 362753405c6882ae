"""spark-submit launcher for the job command line:

    spark-submit --py-files cardrisk.zip jobs/run.py run --raw s3://.../raw --root s3://.../lake --tables

(``cardrisk.zip`` is the zipped package; only the driver imports it.)
"""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardrisk.__main__ import main  # noqa: E402

if __name__ == "__main__":
    print(json.dumps(main(sys.argv[1:]), default=str))
