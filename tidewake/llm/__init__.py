"""Operators for preparing training corpora, apart from the rest of the library.

Functions of this package run inside Python workers that may not have the
repository on their path, so they are sent to the workers by value.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
