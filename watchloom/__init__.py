"""watchloom: supervisory analytics over security-operations logs, as Spark jobs.

Functions of this package travel to the executors by value, so that workers need not have it installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

register_pickle_by_value(sys.modules[__name__])
