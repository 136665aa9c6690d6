"""Rows of a table as plain values."""


def as_set(df, *columns):
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}


def as_dict(df, key):
    return {r[key]: r.asDict() for r in df.collect()}
