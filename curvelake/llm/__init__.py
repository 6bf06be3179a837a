"""Operators for preparing training text at scale.

Nothing else in the library imports this package.  Its Python helpers are sent to the
workers by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
