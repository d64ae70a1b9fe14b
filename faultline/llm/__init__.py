"""Operators of a training-data pipeline: search, extraction, scoring, de-duplication,
archives, token files, quality rules, tokenisation, secret scans and mixing.

Nothing outside this package imports it.  Functions that run in Python workers are pickled by
value, so executors need the third-party libraries only, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
