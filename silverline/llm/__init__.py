"""Operators that prepare text for training language models; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get this subpackage's functions by value, so executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
