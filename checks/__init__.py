"""Registered queries, each beside the SQL that another engine answers on the same tables."""

import sys

from pyspark import cloudpickle

# As in the library: workers need not have this folder on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
