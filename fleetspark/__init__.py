"""Shared-mobility analytics as DataFrame-to-DataFrame functions on Spark."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them: executors need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
