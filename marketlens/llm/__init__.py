"""Training-data operators.  Nothing else in the library imports this package.

The functions that run inside tasks are shipped with the job (pickled by
value), so executors need only the installed third-party libraries, not a
copy of this repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
