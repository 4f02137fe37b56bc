"""Operators for preparing training data, one module each.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Python functions of this package travel with their tasks, so that executors
# need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
