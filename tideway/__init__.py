"""Keyed streams and tables on Spark."""

import sys

from pyspark import cloudpickle

# Processors and folds run in Python workers that need not have this package installed: send its code along.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
