"""Word splitting and word codes for operators that run over Arrow batches.

Texts stay UTF-8 bytes: every separator used here is an ASCII byte, so bytes split at the same places
as characters do.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
MEMO_ENTRIES = 100_000

UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
LOWERED = bytes.maketrans(UPPER, LOWER)
# Lower-cased, with every ASCII byte that is neither letter nor digit turned into a space.
ALNUM = bytes(
    LOWERED[b] if b >= 0x80 or chr(b).isalnum() else 0x20
    for b in range(256)
)


def sliced(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text; a longer text stands alone.

    Python workers outlive their tasks, so what Arrow has freed goes back to the system at the end.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // size
        cuts = np.flatnonzero(np.diff(group)) + 1
        for start, end in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
            if end > start:
                yield batch.slice(start, end - start)
    pa.default_memory_pool().release_unused()


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes; null is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def offsets(counts: list[int]) -> np.ndarray:
    """Start of each run and the end of the last, for runs of the given lengths."""
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64))).astype(np.int64)


class WordCodes(dict):
    """64-bit codes of words, remembered for words seen lately."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def codes(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(codes: np.ndarray) -> np.ndarray:
    """Finalise 64-bit codes so that their high and low bits are well spread."""
    codes = (codes ^ (codes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    codes = (codes ^ (codes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return codes ^ (codes >> np.uint64(32))


def gram_codes(codes: np.ndarray, size: int) -> np.ndarray:
    """Codes of all runs of ``size`` consecutive words."""
    count = len(codes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for shift in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + codes[shift : shift + count]
    return mixed(total)

