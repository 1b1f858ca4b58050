"""opsmill: operations analytics for e-commerce as plain Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python tasks travel with the job, so workers
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
