"""Operators for preparing training data, each one a Spark job over whole tables.

Nothing else in the library imports this subpackage. Its functions are shipped
to the executors by value, so the workers need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
