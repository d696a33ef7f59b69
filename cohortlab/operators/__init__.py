"""DataFrame -> DataFrame operators."""

import sys

from pyspark import cloudpickle

# what tasks run of this package travels with the job, so workers need not have it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
