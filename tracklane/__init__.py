"""tracklane: vehicle-trajectory analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Readers and helpers that run inside tasks travel to the executors by value, so the cluster needs
# no copy of this package on its Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
