"""Operators for large-scale training-data pipelines.

Nothing else in the package imports this subpackage. Functions that run in
Python workers are shipped by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
