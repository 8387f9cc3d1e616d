"""Operators for preparing large text corpora for training."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the jobs that use them, so
# it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
