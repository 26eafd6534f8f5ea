"""Rows of results in a form tests can compare."""


def by(df, *keys):
    """Rows as dicts, sorted by the given columns."""
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((r[k] is not None, r[k]) for k in keys)) if keys else rows
