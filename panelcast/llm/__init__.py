"""Operators for preparing training text.

Functions that run inside tasks are pickled by value, so tasks work wherever the driver was
started. Broadcast encoders and models are objects of this package: on a cluster it must be on
the executors' path (PYTHONPATH or spark.submit.pyFiles), as numpy and pyarrow are.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
