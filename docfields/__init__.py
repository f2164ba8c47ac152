"""Receipt fields at table scale: words in, validated business records out, on Spark."""

import sys

from pyspark import cloudpickle

# Python workers need not have this package installed: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
