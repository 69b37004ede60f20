"""Operators and pipeline for preparing training text. Nothing else in the library imports this package.

Functions that run inside tasks are sent with all they use, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
