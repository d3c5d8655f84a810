"""White-space-delimited chunks of many texts at once: their places and hashes, in vector operations of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes that part chunks: the six ASCII white-space characters.
_SPACE = np.zeros(256, np.bool_)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Chunks are hashed in runs of so many bytes; a longer chunk is hashed by itself.
BLOCK = 1 << 17
_rng = np.random.default_rng(71)
_LETTERS = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_BASES = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _powers(base: int) -> np.ndarray:
    p = np.full(BLOCK, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)  # modulo 2 ** 64


_UP = [_powers(b) for b in _BASES]
_DOWN = [_powers(pow(b, -1, 1 << 64)) for b in _BASES]


#: Kinds of bytes: ASCII letters and, but for the apostrophe, ASCII punctuation.
_LETTER, _MARK = np.zeros(256, np.bool_), np.zeros(256, np.bool_)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def lowered(raw: bytes) -> bytes:
    """A-Z in lower case where an ASCII byte or the end follows, so that no letter which a combining mark may change is touched."""
    data = np.frombuffer(raw, np.uint8)
    upper = (data >= 65) & (data <= 90)
    upper[:-1] &= data[1:] < 128
    return (data + (upper * np.uint8(32))).tobytes()


def chunks(texts: list[bytes], cut: bool = False) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(all bytes, chunk starts, chunk ends, number of the first chunk of each text and of the end). cut: chunks are parted between ASCII letters and punctuation too."""
    raw = b"\n".join(texts)
    data = np.frombuffer(raw, np.uint8)
    word = np.zeros(len(raw) + 2, np.bool_)
    word[1:-1] = ~_SPACE[data]
    apart = np.zeros(len(raw) + 1, np.bool_)  # a boundary before a byte
    if cut and len(raw) > 1:
        letter, mark = _LETTER[data], _MARK[data]
        apart[1:-1] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
    start, end = np.flatnonzero(word[1:] & (apart | ~word[:-1])), np.flatnonzero(word[:-1] & (apart | ~word[1:]))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return raw, start, end, np.searchsorted(start, begins)


def hashes(raw: bytes, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hashes of the chunks: sums of letter values times powers of a base, from running sums. which: 0 or 1, two independent ones."""
    data, out, i = np.frombuffer(raw, np.uint8), np.empty(len(start), np.uint64), 0
    letters, up, down = _LETTERS[which], _UP[which], _DOWN[which]
    sums = np.zeros(BLOCK + 1, np.uint64)
    while i < len(start):
        low = int(start[i])
        j = int(np.searchsorted(end, low + BLOCK, "right"))
        if j <= i:
            out[i] = xxhash.xxh64_intdigest(raw[low : int(end[i])], seed=which)
            i += 1
            continue
        n = int(end[j - 1]) - low
        np.cumsum(letters[data[low : low + n]] * up[:n], out=sums[1 : n + 1])
        at = start[i:j] - low
        out[i:j] = (sums[end[i:j] - low] - sums[at]) * down[at]
        i = j
    out ^= out >> np.uint64(32)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def slices(batch: pa.RecordBatch, column: int, rows: int = 256, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most so many rows and, but for single rows, about so many bytes in a text column."""
    sizes, start, held = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (i - start >= rows or held + n > most_bytes):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def unused(columns: list[str], start: str = "_") -> str:
    """A beginning of names that no column's name has."""
    while any(c.lower().startswith(start) for c in columns):
        start += "_"
    return start
