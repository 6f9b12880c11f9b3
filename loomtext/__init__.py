"""loomtext: web-log and text records to labelled, weighted feature tables on Spark.

Every public operator is a lazy ``DataFrame -> DataFrame`` transformation built from
Spark SQL expressions, joins and aggregations, so Catalyst plans and distributes it.
"""

__version__ = "0.1.0"
