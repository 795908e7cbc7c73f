"""Operators of a training-data pipeline: one module each, plus the queries that apply them."""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value: executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
