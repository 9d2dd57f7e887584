"""Operators of a training-data pipeline over whole corpora.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames and returns a DataFrame; Python code runs on Arrow batches inside
tasks, on pieces of bounded size, and is shipped with the job, so workers need
no installed package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
