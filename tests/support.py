"""Helpers that several test modules share."""


def rows(df):
    """A frame's rows as a sorted list of tuples, for order-free comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
