"""Report, sampling and recommendation jobs for Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the tasks, so that workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
