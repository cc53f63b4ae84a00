"""Operators of a training-data pipeline over tables of documents and web pages.

Python code of this package is sent to the tasks by value, so executors need no
copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
