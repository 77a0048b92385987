"""Operators for preparing language-model training data.

Functions of this package that run on executors are sent by value, and so are broadcast values (``sent``), so that
no package needs to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
