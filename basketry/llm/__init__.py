"""Operators for preparing training data; nothing else in the package imports this one.

Their functions are sent to executors by value, so the package need not be installed there.
Broadcast values are plain arrays and lists for the same reason.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
