"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them: executors need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
