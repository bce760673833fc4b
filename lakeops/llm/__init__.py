"""Operators for training-data pipelines. Code that runs in tasks travels with the plan, so executors need no copy of it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
