"""Entity resolution on Spark: clean, encode, block, score, cluster, keep state."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions for Python workers travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
