"""Operators for training text, each a function from DataFrames to a DataFrame."""

import sys

from pyspark import cloudpickle

# executors get the helpers with the plan; they need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
