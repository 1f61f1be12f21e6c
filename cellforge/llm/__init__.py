"""Operators of a training-data pipeline, one module each, and their queries.

Task functions of this package are pickled by value, so executors need no copy of it.
Intermediate tables go to the shared folder of ``spark.checkpoint.dir`` (``tables.stash``).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
