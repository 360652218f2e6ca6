"""Operators for preparing language-model training data, each as a Spark job.

Every operator reads only the columns it names, so further columns of any name
do no harm; they are left out of the result.  Nothing outside this package
imports it.
"""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
