"""Transaction-risk analytics as PySpark DataFrame and Structured Streaming operators."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers with the task, so no worker needs the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
