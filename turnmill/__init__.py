"""turnmill: prepare and evaluate instruction-tuning corpora on Apache Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Ship task functions by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
