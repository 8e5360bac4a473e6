"""Table preparation and learning on Spark DataFrames.

Every operator takes and returns ordinary DataFrames; fitted objects are
``pyspark.ml`` Estimator / Model pairs, so they chain in a ``Pipeline``.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions that run in tasks travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
