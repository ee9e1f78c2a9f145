"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Functions that run inside tasks are shipped by value, so executors need this package on no path of their own.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
