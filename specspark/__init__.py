"""Spark-native work on spectra, line lists, model grids and ordered series."""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# functions that run on workers travel with the job, so workers need no installed copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
