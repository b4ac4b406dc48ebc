"""Operators for preparing language-model training data.

Tasks carry the functions of this package with them, so that executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
