"""Operators for preparing text corpora: secrets, fingerprints, decontamination, archives, packing and more."""

import sys

from pyspark import cloudpickle

# Functions of these modules go to the executors by value: a worker needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
