"""Operators for training-data pipelines over documents, pages and conversations.

Nothing else in the library imports this subpackage. Task functions travel by
value, so executors need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
