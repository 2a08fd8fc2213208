"""Operators a training-data pipeline needs, one module per operator, with
their queries and SQL in ``queries``. Nothing else in the library imports
this subpackage."""
import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so workers need no copy of
# this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
