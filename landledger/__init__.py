"""Land Ledger: property-records warehousing on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: nothing needs installing there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
