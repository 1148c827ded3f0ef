"""Community-reaction analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with the job; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
