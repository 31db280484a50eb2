"""Training-data operators. Nothing else in the library imports this package.

The package is pickled by value, so executors need no copy of the repository
on their path: every function that a task runs travels with the task.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
