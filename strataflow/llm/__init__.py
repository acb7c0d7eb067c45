"""Operators for training data: filtering, near-duplicates, mixing, formatting, tokens and scores.

Nothing outside this package imports it. Operators named native in the README use only DataFrame functions.
Functions of this package that run in tasks travel by value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
