"""Operators for preparing training text: filters, duplicate removal, mixing, packing, search and sharding.

Functions of this package run inside tasks; they are shipped by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
