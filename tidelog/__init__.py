"""Event-log analytics on Spark DataFrames and Structured Streams.

Events live in an append-only log keyed by ``(event_type, partition)`` with an
increasing ``offset``. Every function takes and returns DataFrames.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the job, so executors
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
