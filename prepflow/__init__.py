"""Prepare tabular data, model it and score it, as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
