"""Operators for preparing training text at scale.

Nothing else in the library imports this package. Functions that run inside
tasks are sent to the workers by value, so executors need only the installed
third-party packages, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
