"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: what a task runs is sent with it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
