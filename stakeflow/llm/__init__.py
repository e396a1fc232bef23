"""Operators for training-data pipelines over documents and embeddings.

Nothing outside this package imports it. ``queries`` registers one query per operator.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
