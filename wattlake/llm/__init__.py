"""Training-data operators.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# What runs in tasks is sent with them, so that executors don't need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
