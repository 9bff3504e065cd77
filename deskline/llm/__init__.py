"""Operators for preparing training data of language models, one module each.

Functions of this package that run inside tasks are shipped by value, so executors
need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
