"""Operators for large text corpora used as training data (one module per operator, see README).

Functions of this package travel to the executors by value, so a cluster needs no copy of the package on its nodes.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
