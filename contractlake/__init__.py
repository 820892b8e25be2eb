"""Nested contract-award XML in, queryable contract and vendor tables out, all on Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks travel with the job, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
