"""Operators of a training-data pipeline: one module each, their queries in `registry`.

Functions that run in Python workers travel with the plan, so workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
