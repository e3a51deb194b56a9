"""Training-data operators: ten corpus operators and the queries that apply
them.  Nothing else in the library imports this subpackage.

What runs in Python workers is sent to them by value, so the executors need
the third-party libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
