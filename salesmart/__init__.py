"""PySpark engine for retail sales files."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are pickled whole, not by module
# reference, so workers need no copy of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
