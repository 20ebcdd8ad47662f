"""Plain rows of a DataFrame, for comparisons in tests."""


def rows(df, *cols):
    """Sorted plain tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
