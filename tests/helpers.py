"""Helpers the test modules import by name."""

SF_SMALL = "/root/testdata/sf0.001"


def _key(t):
    # NULLs sort first, then values of the same column type
    return tuple((v is not None, v if v is not None else 0) for v in t)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
