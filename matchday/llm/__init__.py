"""Operators that prepare training data at corpus scale: one module per operator, and their queries.

Functions that run inside tasks travel by value, so executors need numpy, pandas, pyarrow, xxhash, zstandard and
regex, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
