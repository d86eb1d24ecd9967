"""Operators of a training-data pipeline over document, label and chat tables."""

import sys

from pyspark import cloudpickle

# functions of this package travel to executors whole, where it need not be installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
