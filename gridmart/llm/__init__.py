"""Operators of a training-data pipeline, each a Spark job over whole tables.

Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Executors get these functions with the task, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
