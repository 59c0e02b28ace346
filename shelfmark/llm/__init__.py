"""Operators for preparing training text at scale: scoring, deduplication, archives, packing, search.

Functions that run in Python workers are pickled by value, so that executors need no copy of this
package, whatever folder the driver was started from.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
