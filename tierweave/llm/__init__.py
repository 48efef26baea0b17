"""Operators for preparing text corpora; nothing else in the library imports this package.

Functions that run in Python workers travel by value, so executors need the listed libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
