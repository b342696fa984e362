"""Operators for preparing training data: one module per operator, queries in `queries`."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to executors with the job: nothing to install there.
register_pickle_by_value(sys.modules[__name__])
