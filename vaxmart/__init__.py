"""vaxmart: a PySpark-native vaccination star-schema toolkit.

Ingestion (CSV bulk load with a bad-row budget, partition merge/replace,
incremental extraction by bookmark), a typed staging layer with hashed
surrogate keys, dimension and fact builders, data-quality reports and
parameterised analyses. Everything is DataFrame / Spark SQL code.
"""

__version__ = "0.1.0"
