"""Benchmark decontamination by Wu-Manber search for many word windows.

A window is 13 consecutive words of a benchmark item, or the whole item if it has fewer. The search
moves over a document's words in jumps: a table over two-word blocks tells how far the next possible
end of a window lies. Where it gives zero, the last four words choose a bucket of windows, and each of
them is compared word by word.
"""

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon.llm.text import ALNUM, offsets, sliced, utf8

WINDOW = 13
#: Benchmark text per search table; a larger benchmark is searched in several passes.
BLOCK_BYTES = 8 << 20
SHIFT_BITS = 20
LANE = 256

FOUND = "doc_id long, text string, hit_spans binary, hit_items array<string>"
REPORT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


class Windows:
    """Search table for all windows of one length."""

    def __init__(self, windows: np.ndarray):
        self.windows = windows
        self.length = windows.shape[1]
        self.block = min(2, self.length)
        self.suffix = min(4, self.length)
        self.shift = np.full(1 << SHIFT_BITS, self.length - self.block + 1, np.int32)
        for end in range(self.block - 1, self.length):
            slots = self._slots(windows[:, end - self.block + 1 : end + 1].T)
            np.minimum.at(self.shift, slots, self.length - 1 - end)
        keys = self._suffix_keys(windows[:, self.length - self.suffix :].T)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    @staticmethod
    def _slots(block) -> np.ndarray:
        key = np.zeros(len(block[0]), np.uint64)
        for part in block:
            key = (key + part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return (key >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)

    @staticmethod
    def _suffix_keys(suffix) -> np.ndarray:
        key = np.zeros(len(suffix[0]), np.uint64)
        for part in suffix:
            key = key * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64)
        return key

    def candidates(self, codes: np.ndarray) -> np.ndarray:
        """Last positions at which the shift table doesn't rule out a window."""
        at = np.arange(self.length - 1, len(codes), LANE, dtype=np.int64)
        stop = np.minimum(at + LANE, len(codes))
        found = []
        while len(at):
            block = [codes[at - back] for back in range(self.block - 1, -1, -1)]
            jump = self.shift[self._slots(block)]
            found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            inside = at < stop
            at, stop = at[inside], stop[inside]
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)

    def search(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last position and number of every window that occurs in ``codes``."""
        ends = self.candidates(codes)
        suffix = [codes[ends - back] for back in range(self.suffix - 1, -1, -1)]
        keys = self._suffix_keys(suffix) if len(ends) else np.empty(0, np.uint64)
        first = np.searchsorted(self.keys, keys, "left")
        count = np.searchsorted(self.keys, keys, "right") - first
        ends = np.repeat(ends, count)
        place = np.repeat(first - offsets(count)[:-1], count) + np.arange(len(ends))
        number = self.order[place]
        for back in range(self.length):
            same = codes[ends - back] == self.windows[number, self.length - 1 - back]
            ends, number = ends[same], number[same]
        return ends, number


class Benchmark:
    """The windows of a block of items, by length, with the items that hold each of them."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        self.codes: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, text in items:
            coded = [self.codes.setdefault(w, len(self.codes) + 1) for w in words_of(text)]
            size = min(WINDOW, len(coded))
            for start in range(len(coded) - size + 1 if size else 0):
                held = holders[tuple(coded[start : start + size])]
                if item is not None:
                    held.add(item)
        by_length = defaultdict(list)
        for window in holders:
            by_length[len(window)].append(window)
        self.tables = [Windows(np.array(group, np.int32)) for group in by_length.values()]
        self.holders = [[holders[window] for window in group] for group in by_length.values()]

    def search(self, documents: list[list[bytes]]) -> Iterator[tuple[np.ndarray, set[str]]]:
        """Per document the ``(start, end)`` spans of occurring windows and their items."""
        starts = offsets([len(words) + 1 for words in documents])
        codes = np.zeros(int(starts[-1]), np.int32)  # 0: no word of the benchmark, also between texts
        lookup = self.codes.get
        for start, words in zip(starts.tolist(), documents, strict=False):
            codes[start : start + len(words)] = np.fromiter(
                (lookup(word, 0) for word in words), np.int32, len(words)
            )
        spans = [[] for _ in documents]
        items = [set() for _ in documents]
        for table, holders in zip(self.tables, self.holders, strict=True):
            ends, numbers = table.search(codes)
            rows = np.searchsorted(starts, ends, "right") - 1
            for row, end, number in zip(rows.tolist(), ends.tolist(), numbers.tolist(), strict=True):
                last = end + 1 - int(starts[row])
                spans[row].append((last - table.length, last))
                items[row] |= holders[number]
        for found, held in zip(spans, items, strict=True):
            yield np.array(found, np.int32).reshape(-1, 2), held


def covered(spans: np.ndarray, size: int) -> int:
    """Number of positions below ``size`` inside any of the spans."""
    edges = np.bincount(spans[:, 0], minlength=size + 1) - np.bincount(spans[:, 1], minlength=size + 1)
    return int((np.cumsum(edges) > 0).sum())


def _found(block: Benchmark, batch: pa.RecordBatch, texts: list[list[bytes]]) -> Iterator[tuple]:
    """Per document the spans and items found so far and in this block."""
    earlier = zip(batch.column("hit_spans").to_pylist(), batch.column("hit_items").to_pylist(), strict=True)
    for (found, held), (old_spans, old_items) in zip(block.search(texts), earlier, strict=True):
        yield old_spans + found.tobytes(), sorted(held | set(old_items))


def _search_block(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [words_of(text) for text in utf8(batch.column("text"))]
            spans, items = zip(*_found(shared.value, batch, texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text"),
                    pa.array(spans, pa.binary()),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["doc_id", "text", "hit_spans", "hit_items"],
            )

    return run


def _report(shared):
    """The last block's search and, behind it, the judgement, in one pass over the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            texts = [words_of(text) for text in utf8(batch.column("text"))]
            for words, (spans, items) in zip(texts, _found(shared.value, batch, texts), strict=True):
                size = len(words)
                hit = covered(np.frombuffer(spans, np.int32).reshape(-1, 2), size) if spans else 0
                digest = hashlib.sha256(",".join(items).encode()).hexdigest()
                rows.append((size, hit, len(items), digest, hit > 0 and 20 * hit >= size))
            values = list(zip(*rows, strict=True))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, t) for v, t in zip(values, types, strict=True))],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return run


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document its words, the words hit, the items found and whether it is contaminated.

    A document is contaminated if at least one word in twenty is hit. Null texts have no words, an item
    without words matches nothing, and items that repeat a text all count. An item without an id hits
    words like any other, but is neither counted nor listed. Repeated rows each get their
    own result, a null ``doc_id`` stays null, an empty table gives no rows, and further columns are
    ignored.

    A search table holds at most about ``BLOCK_BYTES`` of benchmark text and is broadcast. A larger
    benchmark runs as several passes one after another in the same stage, so neither its size nor
    that of the documents moves any text.
    """
    spark = documents.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")
    ).filter("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_BYTES
    found = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lit(b"").alias("hit_spans"),
        F.array().cast("array<string>").alias("hit_items"),
    )
    for number in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        rows = [(row.item_id, bytes(row.text)) for row in part.toLocalIterator()]
        shared = spark.sparkContext.broadcast(Benchmark(rows))
        if number < blocks - 1:
            found = found.mapInArrow(_search_block(shared), FOUND)
    return found.mapInArrow(_report(shared), REPORT)
