"""Operators that prepare training data; nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
