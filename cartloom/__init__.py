"""Commerce data operators on PySpark: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

# The few Python helpers that run in tasks travel with the plan, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
