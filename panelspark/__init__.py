"""Customer-panel analytics and propensity modelling as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of this package travel to Python workers with their code, so that it need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
