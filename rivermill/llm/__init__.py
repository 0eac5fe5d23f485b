"""Operators for preparing training text at scale.

Each module holds one operator as a plain function from DataFrame to DataFrame; `queries`
applies them to the given tables. Functions of this package travel to the executors by
value, so a cluster needs no copy of it on the workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
