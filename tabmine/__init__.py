"""tabmine — distributed data-quality, feature, statistics, clustering,
classification and evaluation operators on Spark DataFrames.

Layout:
  sources/    readers, writers and the derived review views
  functions/  column expressions (text cleaning, hashing, bands)
  operators/  DataFrame -> DataFrame operators and Spark ML wrappers
  plans/      named queries (+ DuckDB oracle SQL) built from the operators
  streaming/  stream-side use of the stateless operators
"""

import sys

from pyspark import cloudpickle

from tabmine.session import get_spark, ensure_checkpoint_dir
from tabmine.spec import FeatureSpec, Preset

__all__ = ["get_spark", "ensure_checkpoint_dir", "FeatureSpec", "Preset"]

# Functions of this package that run in Python workers travel with their tasks, so executors need
# no copy of it and the driver may start in any folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
