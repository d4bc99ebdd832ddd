"""Review-rating features, scoring and evaluation as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
