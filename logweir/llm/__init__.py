"""Operators for building training data out of large text corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Executors get the functions with the job: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
