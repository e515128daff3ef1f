"""Operators of a training-data pipeline over ``documents``, ``pages``, ``labels`` and ``benchmark``.

Nothing outside this folder imports it. Its functions are shipped to the executors by
value, so a cluster needs no copy of the package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
