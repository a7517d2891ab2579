"""Operators of a training-data pipeline, one module each.

Nothing outside this subpackage imports it.  The modules hold general operators from
DataFrame to DataFrame; `queries` applies each to its whole table.
"""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
