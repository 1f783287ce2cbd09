"""Spark DataFrame operators and flows for financial-text datasets.

Functions of this package are shipped to executors by value, so executors need not
have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
