"""How the tests read a DataFrame."""


def rows(df, *order):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*order or df.columns).collect()), key=repr)
