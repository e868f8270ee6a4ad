"""Citation records as Spark DataFrames: read, enrich, gate, unfold, write."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions run in tasks travel with the job, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
