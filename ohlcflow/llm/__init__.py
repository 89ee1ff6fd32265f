"""Operators for large text corpora (training data preparation).

Their task functions travel to the executors by value, so executors need numpy
and pyarrow but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
