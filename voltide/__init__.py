"""voltide: panel analytics for price bars, written with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Worker functions travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
