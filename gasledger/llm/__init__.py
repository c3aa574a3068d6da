"""Operators for preparing language-model training data.

One module per operator, each a function from DataFrames to a DataFrame; the
registered queries (``op1_`` ... ``op13_``) and their SQL live in ``queries.py``.
Nothing outside this subpackage imports it.

The helper code that runs inside Python tasks travels with the job (pickled by
value), so executors need the public libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
