"""Spark-native analytics over a corpus of C source code."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so a cluster
# needs no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
