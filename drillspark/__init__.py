"""A Spark-native analytics engine for daily drilling reports."""

import sys

from pyspark import cloudpickle

# functions go to Python workers by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
