"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python workers get these functions with their tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
