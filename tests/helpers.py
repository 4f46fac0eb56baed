"""What several test modules share; kept out of conftest, whose name is not unique to one folder."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(type(v)), 0 if v is None else v) for v in r))
