"""Helper of the corpus tests."""


def same_rows(operator, plain, clashing, digits=9, drop=()):
    """The operator's sorted rows over a table, the same with clashing extra columns."""
    def key(df):
        got = operator(df)
        got = got.drop(*drop)
        return sorted((tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in got.collect()), key=repr)

    a = key(plain)
    assert a == key(clashing)
    return a
