"""Backup, inspection and restore of partitioned message logs as Spark jobs."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
