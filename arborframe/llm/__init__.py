"""Operators for training-data pipelines: extraction, scoring, mixing, deduplication, packing."""

import sys

from pyspark import cloudpickle

# Tasks receive this package's code with each job, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
