"""Duplicate-text-pair analytics expressed as Spark DataFrame transforms."""

import sys

from pyspark import cloudpickle

# Executors need no copy of the package: the few functions that run in Python tasks
# travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
