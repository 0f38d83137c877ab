"""Words of whole texts as bytes, for tasks that run in Python."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: Lower-cases A-Z and nothing else.
LOWER = bytes.maketrans(_UPPER, _LOWER)
#: Lower-cases A-Z and turns every ASCII character but letters and digits into a space.
LETTERS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def utf8(texts: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()


def space_words(text: bytes | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z lower-cased."""
    return text.translate(LOWER).split() if text else []


def letter_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased."""
    return text.translate(LETTERS).split() if text else []


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets at which the ``letter_words`` of a text start and end."""
    flags = np.frombuffer(raw.translate(LETTERS), dtype=np.uint8) != 0x20
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
