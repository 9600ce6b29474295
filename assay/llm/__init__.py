"""Operators for training-data pipelines; nothing else in the library imports this subpackage.

Their Python functions travel to the executors by value, so executors need numpy, pyarrow
and the compression libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
