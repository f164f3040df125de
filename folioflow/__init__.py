"""Document preparation on Spark: cleaning, chunking, auditing, tagging and export as DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
