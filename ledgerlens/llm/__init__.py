"""Training-data operators: one module per operator, queries and SQL beside them.

Functions of this package travel to the executors by value, so workers need
numpy, pandas and pyarrow but no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
