"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one operator with a
general interface; :mod:`herdfeed.llm.queries` registers the thin ``opN_<name>`` queries.
Functions of this package that run inside tasks are pickled by value, so executors need
numpy and pyarrow but no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
