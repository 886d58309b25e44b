"""Vectors as integers: each component x becomes floor(256 * x), x as double."""

from __future__ import annotations

from collections.abc import Iterator

SCALE = 256
#: Squared length, in integers, up to which ten times an inner product and any squared distance of two vectors fit a long.
LONGEST = 2**59


def integer_rows(column, length: int | None = None) -> Iterator[tuple]:
    """(places, int64 matrix) for each vector length among the rows of an Arrow list column that hold a usable vector.

    Null vectors, vectors with a null or non-finite component and, with ``length``, vectors of another length are left out, as are
    vectors beyond `LONGEST`: a long could not hold what is computed from them.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy()
    for n in np.unique(lengths):
        if n < 0 or (length is not None and n != length):
            continue
        at = np.flatnonzero(lengths == n)
        values = column.take(pa.array(at)).flatten().cast(pa.float64())
        x = np.array(values.fill_null(float("nan"))).reshape(len(at), n)
        with np.errstate(over="ignore", invalid="ignore"):
            x = np.floor(SCALE * x)
            good = (x * x).sum(axis=1) <= LONGEST  # false where a component is not finite
        if good.any():
            yield at[good], x[good].astype(np.int64)


def matrix(blobs: list[bytes], kind: str = "<i4"):
    """Rows of equally long blobs as an int64 matrix."""
    import numpy as np

    if not blobs:
        return np.zeros((0, 0), dtype=np.int64)
    return np.frombuffer(b"".join(blobs), dtype=kind).reshape(len(blobs), -1).astype(np.int64)
