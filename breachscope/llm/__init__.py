"""Operators for preparing training data.

Functions that run inside Python tasks travel with the task, so executors need no
copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
