"""docwatch: monitoring of document streams as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so the executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
