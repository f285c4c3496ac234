"""Operators that turn raw documents into training data.

Nothing else in the library imports this package. Its Python functions travel to the
executors by value, so a cluster need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
