"""vecframe: similarity search and embedding-table jobs on plain PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Task functions travel to the Python workers by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
