"""Shardlog: change-data-capture streams of sharded databases on PySpark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the plan, so they need no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
