"""Cadenza: batch recommendation analytics over item catalogs, written as Spark jobs."""

import sys

from pyspark import cloudpickle

# functions sent to executors travel inside the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
