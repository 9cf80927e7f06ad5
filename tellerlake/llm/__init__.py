"""Operators for preparing training data: quality, near duplicates, personal data, mixing, packing, search, archives.

Functions of this package that run in Python workers are shipped by value, so that a cluster needs
no copy of the package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
