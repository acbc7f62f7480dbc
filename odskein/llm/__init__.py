"""Operators for large training-data pipelines. Nothing else in the package imports this one.

Functions of this folder that run in Python workers are sent there whole, so executors need not
have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
