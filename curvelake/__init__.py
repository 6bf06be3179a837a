"""curvelake — rates/credit time series and company filings on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark's built-in expressions; nothing is collected to the driver.
"""

__version__ = "0.1.0"
