"""Operators of a training-data pipeline over large tables of texts and vectors.

Nothing else in the library imports this package. Its task-side functions are
shipped by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
