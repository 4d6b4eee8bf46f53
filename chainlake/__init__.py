"""chainlake: event-log lake operators on PySpark.

Rows of the feeds handled here are events about records, not the records. Every
operator takes DataFrames, a per-source `Contract` and, where time matters, an
explicit `as_of`, and returns a lazy DataFrame.
"""

import sys

from pyspark import cloudpickle

from chainlake.contract import Contract, EventColumns

__all__ = ["Contract", "EventColumns"]

# Functions that run in tasks travel with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
