"""obsledger: Spark jobs over tables of dated observations per entity.

Every function takes and returns DataFrames (or Columns) and is parameterised
by column names, so the same job runs on weather stations, customers,
suppliers or devices.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package travel to the workers whole, so executors need no copy of it on their path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
