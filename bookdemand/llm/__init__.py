"""Operators for building training data at scale: archives, tokens, filters,
near-duplicates, privacy, mixing, extraction and search.

Functions that run inside tasks are shipped by value, so executors need only
PySpark and the libraries a module imports, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
