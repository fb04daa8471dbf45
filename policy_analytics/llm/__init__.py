"""Operators for preparing training corpora; nothing else in the library imports them.

Functions of this subpackage travel to the executors by value, so they need not be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
