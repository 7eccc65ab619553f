"""Operators for preparing training text at scale. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Tasks run functions of this package; sending them by value asks nothing of the executors' paths.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
