"""Operators for preparing training text; nothing else in the library imports them.

Functions that run in Python workers are shipped by value, so executors need only
the public libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
