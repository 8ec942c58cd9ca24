"""Operators for training-data pipelines over text, pages and embeddings.

The functions that run inside Python tasks are pickled by value, so that executors need no
copy of this package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
