"""tabletrust: table contracts, approximate comparison and run history on Spark.

Every operator takes and returns Spark DataFrames (or Columns for the
scalar functions) so the work is planned by Catalyst and runs on the
executors; nothing is gathered on the driver.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# The few Python helpers that run inside tasks (Arrow UDFs, the dump
# tokenizer) are shipped by value with the task, so executors need no
# installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from tabletrust.contract import Col, ForeignKey, TableContract  # noqa: E402
from tabletrust.session import build_session, checkpoint_dir, scratch_path  # noqa: E402

__all__ = [
    "Col",
    "ForeignKey",
    "TableContract",
    "build_session",
    "checkpoint_dir",
    "scratch_path",
]
