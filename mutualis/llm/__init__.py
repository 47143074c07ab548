"""Operators for training-data pipelines. Nothing else in the library imports this subpackage.

Functions that run inside Python workers are shipped by value, so the workers need not have this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
