"""aerolayer: a Spark-first engine for aviation/GIS source data and raster layers."""

import sys

from pyspark import cloudpickle

#: Functions travel to executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
