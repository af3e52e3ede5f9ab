"""Machine telemetry on Spark: decode, route, clean, embed, store and summarise envelope messages."""

import sys

from pyspark import cloudpickle

# Functions for the Python workers travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
