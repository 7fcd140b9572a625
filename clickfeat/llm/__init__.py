"""Operators of a training-data pipeline: dedup, mixing, scoring, extraction, scans."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
