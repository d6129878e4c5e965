"""Text-concept (LSA) and sensor-outlier analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Task functions travel whole to the executors, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
