"""Frames as values, for comparing."""


def rows(df, *order):
    """Collected rows as plain tuples, sorted."""
    out = [tuple(row) for row in (df.select(*order) if order else df).collect()]
    return sorted(out, key=lambda row: tuple((value is not None, str(value)) for value in row))
