"""Operators of a training-data pipeline: thirteen of them, their queries, and shared helpers.

Functions that run on executors are shipped by value, so executors need no
copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
