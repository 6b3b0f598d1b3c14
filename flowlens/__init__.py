"""flowlens: packet-capture window analytics expressed as Spark DataFrame plans.

Every operator is a function DataFrame -> DataFrame (or a small set of them);
the heavy lifting is done by Spark SQL (aggregates, windows, joins, shuffles).
"""

__version__ = "0.1.0"
