"""Training-data operators and their queries; nothing outside this subpackage imports it.

The functions that run in Python workers travel with the job (pickled by value), so
a cluster's executors need this package's dependencies but not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
