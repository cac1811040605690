"""tremor: condition monitoring of machines from sensor recordings, on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
expressions and Spark ML stages.  See README.md for the layout.
"""

__version__ = "0.1.0"
