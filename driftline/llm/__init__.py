"""Operators for building language-model training data, and the queries that apply them.

Nothing else in the library imports this package. Its functions travel to the tasks by
value, so executors need no copy of the package on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
