"""Operators of a training-data pipeline: filters, dedup, mixing, packing."""

import sys

from pyspark import cloudpickle

# Functions for Python workers travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
