"""Registered queries and the SQL they are checked against."""

QUERIES = {}
ORACLES = {}


def query(sql=None):
    """Register a query under its function name, with the SQL of its result."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
