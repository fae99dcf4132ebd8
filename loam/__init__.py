"""loam: table-level data science on Spark.

Every operator is a function from DataFrames (plus column-name parameters) to
DataFrames.  Catalyst plans them; nothing is collected to the driver except
bounded scalars (a row count, a handful of level names, a model object).

Sub-packages
------------
sources     reading/writing tables, CSV/text scans, inspection, the test views
operators   relational operators, sampling/folds, ranking, metrics
functions   column expressions (geo distance, factors, text features)
plans       model fitting/scoring, registry, sweeps, grouped forecasting
streaming   scoring newly arriving rows with Structured Streaming
"""

from loam.session import get_spark, checkpoint_dir, read_table, read_tables

__all__ = ["get_spark", "checkpoint_dir", "read_table", "read_tables"]
__version__ = "0.1.0"
