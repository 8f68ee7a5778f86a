"""Operators for preparing training text; nothing else in the library imports them.

Functions that Spark sends to its Python workers travel by value, so the workers need no
copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
