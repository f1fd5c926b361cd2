"""Operators for large-scale training-data pipelines.

Each module holds one operator with its own general interface; ``queries``
derives the fixed-contract queries from them.  Nothing else in the library
imports this package.

Functions that run inside tasks are shipped by value, so executors need the
public libraries (numpy, pyarrow) but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
