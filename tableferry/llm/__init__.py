"""Operators for building language-model training data.

Nothing else in the library imports this package. Each operator names the columns it
reads; other columns of its input are ignored or passed through as its docstring says.
"""

import sys

from pyspark import cloudpickle

# Executors then need NumPy, PyArrow and the codecs, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
