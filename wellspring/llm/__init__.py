"""Operators of a training-data pipeline. Nothing else in the package imports this folder."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors by value, so that a cluster
# needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
