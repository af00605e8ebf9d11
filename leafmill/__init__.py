"""leafmill: document analytics on Spark DataFrames.

Operators are functions from DataFrame to DataFrame. The package ships to Python workers by value, so executors need
no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
