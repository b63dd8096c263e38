"""Document-corpus analytics as plain functions from DataFrames to lazy DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
