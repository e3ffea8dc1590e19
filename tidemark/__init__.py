"""Market time-series analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tidemark.session import materialize, scratch_root, spark_session

__all__ = ["materialize", "scratch_root", "spark_session"]

# Functions sent to Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
