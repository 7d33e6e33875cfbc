"""fleetzone: geofenced fishing activity and landings attribution on Spark.

Every operator is a DataFrame / Spark SQL plan: column expressions,
joins, aggregates and higher-order array functions.  No Python UDF is
used anywhere in the library.
"""

__version__ = "0.1.0"
