"""Training-data operators: one module per operator, queries in ``queries``.

Functions that run inside Spark tasks are pickled by value, so executors do
not need this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
