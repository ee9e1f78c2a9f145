"""Helpers shared by the tests."""


def rows(df, *cols):
    """Rows as sorted plain tuples."""
    df = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in df.collect()), key=repr)
