"""Operators for preparing training data: one module per operator, queries and SQL in ``catalog``.

Functions of this package travel to the executors by value, so that workers need not have it installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
