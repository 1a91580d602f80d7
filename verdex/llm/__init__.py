"""Operators for preparing language-model training data, and their registered queries."""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the workers whole, so it need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
