"""Sales and operations analytics on Spark: batch jobs over landed point-of-sale pages."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so that workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
