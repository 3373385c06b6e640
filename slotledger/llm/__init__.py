"""Operators for training-data pipelines. Nothing else in the package imports this one.

Functions that run in Python workers travel with the task, so the workers need
the third-party libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
