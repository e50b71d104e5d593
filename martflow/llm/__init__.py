"""Operators for preparing training text at scale. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: functions that run in tasks travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
