"""Operators for preparing language-model training data.

Functions of this package travel to the executors by value, so executors need no copy of it.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
