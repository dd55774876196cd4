"""Small helpers shared by the tests."""

import datetime as dt


def rows(df, *columns):
    """Sorted tuples of the named (or all) columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(x is not None, str(x)) for x in t])


def day(text):
    return dt.date.fromisoformat(text) if text else None


def moment(text):
    return dt.datetime.fromisoformat(text) if text else None
