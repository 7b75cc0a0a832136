"""Operators for training-data pipelines; nothing else in the library imports this package.

Functions of this package run inside Python workers that need not have the
repository on their path, so they are shipped by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
