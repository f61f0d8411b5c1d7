"""Analytics for observational data on Spark DataFrames.

Every operator takes DataFrames, column names and parameters and returns a DataFrame.
Most are lazy; those that must know sizes or cut a lineage run jobs when called (the README
lists them). Domain constants (species, depths, site lists, bounds) are arguments.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
