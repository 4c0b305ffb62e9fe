"""Evidence extraction, resolution and adjudication on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# The pandas UDF helpers travel to the executors by value, so a job works
# whether or not the package is installed on the worker image.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
