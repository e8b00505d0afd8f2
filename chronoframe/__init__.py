"""chronoframe — panel time-series analytics on Spark.

Operators are pure ``DataFrame -> DataFrame`` functions built from Spark SQL
expressions, window functions, joins and aggregations. Entity, order and
value columns are parameters; the hourly-weather configuration in
:mod:`chronoframe.config` is one preset.
"""

from chronoframe.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
