"""placeseek: place-name tables prepared, enriched and searched with Spark.

Subpackages: ``sources`` (Excel, CSV, views, file audit), ``functions``
(Column expressions), ``operators`` (DataFrame -> DataFrame steps),
``plans`` (whole jobs), ``sinks`` (index append, JSON lines, previews) and
``streaming``.  Nothing here creates a session; every function takes the
caller's DataFrames or ``SparkSession``.
"""

__version__ = "0.1.0"
