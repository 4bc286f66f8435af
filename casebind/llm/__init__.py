"""Operators for preparing language-model training data. Nothing else in casebind imports this."""

import sys

from pyspark import cloudpickle

# tasks get these functions by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
