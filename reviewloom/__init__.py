"""Review analytics on Spark: every step is a DataFrame or Column function."""

import sys

from pyspark import cloudpickle

# Python functions sent to executors travel by value, so that the workers need
# no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
