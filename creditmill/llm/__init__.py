"""Operators of a training-data pipeline.

Functions of this package go to the executors by value, so tasks need no copy of the
package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
