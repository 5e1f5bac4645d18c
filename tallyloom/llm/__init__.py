"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks carry the code of this subpackage with them, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
