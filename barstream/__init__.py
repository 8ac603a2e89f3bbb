"""Market time series and tabular learning as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Ship the functions that run inside tasks with the job itself, so executors
# need no copy of this package on their Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
