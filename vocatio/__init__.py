"""Occupation classification of job postings as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that the
# workers need not be able to import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
