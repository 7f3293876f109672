"""Operators of a training-data pipeline: one module each, and their registered queries.

Every operator takes and returns DataFrames. Functions that run inside Python tasks are
shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
