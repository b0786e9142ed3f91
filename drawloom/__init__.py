"""Plant-document analytics and training-data operators on Spark."""

import sys

from pyspark import cloudpickle

# functions go to the executors by value, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
