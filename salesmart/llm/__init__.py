"""Operators for preparing language-model training data.

Each module holds one operator: a function over DataFrames with its own
general interface. ``queries`` binds them to the given tables. Nothing else
in the library imports this subpackage.

Functions that run inside Python workers are pickled by value, so a driver
that imports the package from a checkout works without installing it on the
executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
