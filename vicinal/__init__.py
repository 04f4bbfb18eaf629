"""Nearest-neighbour search, vector encodings and re-ranking as Spark jobs."""

import sys

from pyspark import cloudpickle

# Task functions of this package travel inside the serialized plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
