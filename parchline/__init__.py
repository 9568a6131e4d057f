"""Document-to-retrieval data work as plain Spark jobs.

Everything is a ``DataFrame -> DataFrame`` function: ``functions`` holds column
expressions, ``operators`` the jobs built from them, ``sources`` readers and
writers, ``streaming`` the continuous flows, ``plans`` the registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
