"""Operators for training-data pipelines over ``documents``-like tables.

Nothing outside this subpackage imports it. Each operator is a module with a general
function over DataFrames and, at its end, the thin ``op<N>_<name>`` query of the contract;
:mod:`quarry.llm.queries` lists the queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# what runs in tasks is shipped with them: executors need nothing installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
