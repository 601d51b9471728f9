"""Words of texts as bytes. The separators of the operators here are ASCII characters, so
UTF-8 text can be cut byte by byte and gives the same words as code point by code point."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = UPPER.lower()


def translation(become: dict[bytes, bytes]) -> bytes:
    """Table for ``bytes.translate``: A-Z in lower case, and each byte of a key its value."""
    table = bytearray(bytes.maketrans(UPPER, LOWER))
    for sources, target in become.items():
        for b in sources:
            table[b] = target[0]
    return bytes(table)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a string column as bytes; a null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def slices(values: list[bytes], size: int) -> Iterator[slice]:
    """Runs of neighbouring texts of at least ``size`` bytes together (the last: what is left)."""
    start = total = 0
    for i, v in enumerate(values):
        total += len(v) + 1
        if total >= size:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(values):
        yield slice(start, len(values))


def cut(data: bytes, separators: bytes) -> pa.Array:
    """The words of ``data`` between the separators, empty ones too."""
    found = np.frombuffer(data, np.uint8)
    table = np.zeros(256, bool)
    table[list(separators)] = True
    between = table[found]
    ends = np.flatnonzero(between)
    offsets = np.concatenate([[0], ends - np.arange(len(ends)), [len(found) - len(ends)]]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(found[~between])])


def numbered(tokens: pa.Array, first: bytes) -> tuple[list[bytes], np.ndarray]:
    """The distinct tokens, ``first`` at 0, and each token's number among them."""
    coded = pa.concat_arrays([pa.array([first], pa.binary()), tokens]).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy()[1:].astype(np.int64)


def as_text(words: list[bytes]) -> pa.Array:
    return pa.array(words, pa.binary()).cast(pa.string())
