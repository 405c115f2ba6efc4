"""Operators of a training-data pipeline over text tables. Nothing else in the library imports this package.

Functions of this package that run in tasks travel with the job, so executors need no copy of it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
