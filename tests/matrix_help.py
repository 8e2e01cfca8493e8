"""Data folders and small-matrix helpers of the tests. A module of its own: ``conftest`` is the
name of more than one file here."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def cells(spark, values, shape=None):
    """A small dense matrix (nested lists) as a cell table."""
    import numpy as np

    from tessera.core import Cells, coord_names
    arr = np.asarray(values, dtype=float)
    shape = shape or arr.shape
    arr = arr.reshape(shape)
    rows = [tuple(int(i) for i in idx) + (float(arr[idx]),) for idx in np.ndindex(*shape)]
    cols = coord_names(len(shape)) + ["value"]
    schema = ", ".join(f"{c} bigint" for c in cols[:-1]) + ", value double"
    return Cells(spark.createDataFrame(rows, schema), tuple(shape))


def dense(c):
    """Collect a small cell table back into a numpy array."""
    import numpy as np
    out = np.full(c.shape, np.nan)
    for r in c.df.collect():
        out[tuple(r[n] for n in c.coords)] = r["value"]
    return out
