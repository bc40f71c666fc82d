"""Split tables into spreadsheet-sized pieces on Spark, and prove later that the pieces still hold what the tables held."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
