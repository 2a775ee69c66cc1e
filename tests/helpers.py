"""Helpers of the tests."""


def rows(df):
    """Rows as a sorted list of tuples, for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
