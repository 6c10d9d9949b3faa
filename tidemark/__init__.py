"""Event-behaviour analytics as plain DataFrame functions on Spark."""

import sys

from pyspark import cloudpickle

# Ship the small task functions with each job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
