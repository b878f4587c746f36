"""Spark-native evidence-to-catalog engine: every operator is a function from DataFrames to a DataFrame."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so these need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
