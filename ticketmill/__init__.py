"""Support-ticket analytics expressed as Spark DataFrame, ML and streaming jobs."""

import sys

from pyspark import cloudpickle

# Functions shipped to tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
