"""Operators for preparing training data. Nothing else in the library imports this subpackage.

Task functions are pickled by value, so that executors need not have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
