"""Operators for training-data corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# The code of Python stages travels with the plan: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
