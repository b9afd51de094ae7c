"""What several test modules share."""


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)
