"""Operators for preparing language-model training data. Nothing outside imports this package.

Functions of this package travel to the executors by value, so they need no copy of it there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
