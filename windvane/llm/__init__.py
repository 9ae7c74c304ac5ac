"""Operators for preparing training text: scoring, near duplicates, languages, secrets, tokens, packing."""

import sys

from pyspark import cloudpickle

# task functions travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
