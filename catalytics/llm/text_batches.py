"""Byte-level batching of texts inside tasks: bounded pieces of long texts and
bounded groups of short ones."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

#: Lower-cases A-Z only, in UTF-8 bytes; nothing else changes.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes that a task holds as one batch, apart from a longer single word.
BATCH_BYTES = 4 << 20


def cut(data: bytes, gap: re.Pattern[bytes], limit: int = BATCH_BYTES) -> Iterator[bytes]:
    """``data`` in pieces of about ``limit`` bytes, each ending with a byte
    that ``gap`` matches, so no word lies in two pieces."""
    at = 0
    while len(data) - at > limit:
        m = gap.search(data, at + limit)
        if m is None:
            break
        yield data[at:m.end()]
        at = m.end()
    yield data[at:]


def grouped(items: Iterable[tuple], limit: int = BATCH_BYTES) -> Iterator[list[tuple]]:
    """Lists of consecutive items whose first fields, bytes, have at most
    ``limit`` bytes together, or one item."""
    held: list[tuple] = []
    size = 0
    for item in items:
        if held and size + len(item[0]) > limit:
            yield held
            held, size = [], 0
        held.append(item)
        size += len(item[0])
    if held:
        yield held
