"""Operators for preparing training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions for the executors carry their code, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
