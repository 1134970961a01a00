"""Distributed data-quality, monitoring, feature and evaluation operators for Spark."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors with their code, so the package need
# not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
