"""What several test modules share."""


def rows_of(df, *columns):
    """Rows as sorted tuples, for comparison."""
    columns = columns or sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
