"""Operators for preparing training text and embeddings at scale.

Functions of this package run inside Spark's Python workers.  They are sent by
value, so an executor needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
