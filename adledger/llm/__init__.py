"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage. Each module holds one operator;
``queries`` registers one query per operator over its whole table.
"""

import sys

from pyspark import cloudpickle

#: Executors get these functions with the task: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
