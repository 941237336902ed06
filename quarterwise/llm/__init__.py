"""Operators of a training-data pipeline. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
