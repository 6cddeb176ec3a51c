"""Operators of a training-data pipeline: cleaning, duplicates, filters, mixing, tokens."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions for tasks travel with their code, so that executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
