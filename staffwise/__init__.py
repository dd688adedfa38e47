"""staffwise: people-data and workforce analytics on Spark DataFrames."""

import sys

# Functions of this package that run on executors (the distinct-key resolver
# of J11, the workbook parser) are pickled by value, so executors need no
# installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship with --py-files instead
    pass
