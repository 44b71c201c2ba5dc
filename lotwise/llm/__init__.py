"""Operators for training-data pipelines: scoring, cleaning, deduplication, mixing, encoding.

Nothing else in the library imports this subpackage. Its task functions are pickled by
value, so executors need numpy and pyarrow but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
