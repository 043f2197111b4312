"""Operators for preparing language-model training data.

Functions of this subpackage run inside Python workers. They are pickled by
value, so that workers need numpy, pyarrow and pandas but no copy of this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
