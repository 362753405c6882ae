"""Training-data operators: dedup, decontamination, quality, mixing, archives.

Task functions of this subpackage travel to the executors by value, so a cluster
needs numpy, pandas and pyarrow there but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
