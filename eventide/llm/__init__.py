"""Operators of a training-data pipeline over text tables.

One module per operator; ``queries`` registers them. Nothing else in the
library imports this subpackage. Its functions are pickled by value, so
executors need no copy of the package: whatever a task runs travels with it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
