"""Building-energy simulation outputs on Spark.

Sub-packages
------------
``functions``  column expressions (timestamps, names, lookups)
``sources``    file readers and the Parquet tables
``operators``  DataFrame -> DataFrame operators
``plans``      whole jobs made of the operators
``streaming``  the load job over newly arriving files
``queries``    the queries registered in ``__spark_entry__``
"""
