"""Training-data operators; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so workers need no copy of the repository on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
