"""Training-data operators: cleaning, deduplication, mixing, tokenising, archives and search."""

import sys

from pyspark import cloudpickle

# Functions run by workers travel with their tasks: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
