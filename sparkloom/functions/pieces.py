"""Arrow batches in pieces of bounded size, so that the Python objects of a whole batch never exist at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

#: Bytes of the columns of a piece; a row beyond it is a piece of its own.
PIECE_BYTES = 1 << 18


def pieces(columns: tuple[pa.Array, ...], most: int = PIECE_BYTES) -> Iterator[tuple[pa.Array, ...]]:
    """The columns in runs of rows of at most ``most`` bytes, halved as often as it takes."""
    n = len(columns[0])
    if n <= 1 or sum(c.nbytes for c in columns) <= most:
        yield columns
        return
    for first, length in ((0, n // 2), (n // 2, n - n // 2)):
        yield from pieces(tuple(c.slice(first, length) for c in columns), most)


def in_pieces(function: Callable[..., pa.Array]) -> Callable[..., pa.Array]:
    """A function of columns, called for one piece after the other."""

    def run(*columns: pa.Array) -> pa.Array:
        return pa.concat_arrays([function(*piece) for piece in pieces(columns)])

    return run
