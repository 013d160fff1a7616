"""Training-data operators: language id, HTML text, substring and near duplicates,
quality rules and ranking, decontamination, secrets, mixing and sharding.

Every module works on DataFrames; ``queries.py`` registers one query per operator.
Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python tasks travel with the task, so executors need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
