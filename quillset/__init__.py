"""Prepare and evaluate corpora of research papers with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in executors travel with their job, so no package is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
