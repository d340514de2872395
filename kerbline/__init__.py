"""Area time-series analytics written on the PySpark DataFrame API."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that executors
# need no copy of it and the working folder does not matter.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
