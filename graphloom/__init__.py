"""Incremental code property graphs as Spark DataFrame and streaming jobs."""

import sys

from pyspark import cloudpickle

# Send the package's functions to Python workers as code, so that it has to be installed, or on the
# path, only where the driver runs.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
