"""Operators for preparing text corpora, their queries and SQL oracles."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage go to the executors by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
