"""Operators for training-data pipelines.

Functions that run in tasks are sent to the executors by value, so these need no copy of
the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
