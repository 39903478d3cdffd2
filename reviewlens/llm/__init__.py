"""Operators for preparing training text at scale, and their registered queries."""

import sys

from pyspark import cloudpickle

# Functions used in tasks travel with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
