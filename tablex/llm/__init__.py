"""Operators of a training-data pipeline, each beside the query that applies it to a whole table.

Functions of this subpackage that run in Python workers travel with their task: executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
