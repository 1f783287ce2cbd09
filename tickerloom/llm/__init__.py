"""Operators of a training-data pipeline, each with a registered query.

Functions of this subpackage are shipped to executors by value, so executors
need not have it installed.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
