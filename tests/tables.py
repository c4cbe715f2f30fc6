"""Rows of a result, for comparison."""


def rows(df, *order):
    """Rows as plain tuples, sorted for comparison unless an order is not wanted."""
    got = [tuple(r) for r in df.collect()]
    return got if order == ("as_is",) else sorted(got, key=lambda r: tuple((v is None, str(v)) for v in r))
