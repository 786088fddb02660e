"""Rows of a frame in an order of their own, for comparisons."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
