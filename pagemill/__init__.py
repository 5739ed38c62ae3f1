"""pagemill: document preparation and retrieval as Spark jobs."""

import sys

from pyspark import cloudpickle

# The few Python kernels travel inside the task, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
