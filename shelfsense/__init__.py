"""Product-recommendation analytics as Spark DataFrame transformations."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Task code travels with its job, so executors need no copy of this package installed.
register_pickle_by_value(sys.modules[__name__])
