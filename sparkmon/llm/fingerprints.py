"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into phrases, each the shortest one not seen before in that text. The set of its phrases
is hashed, and the smallest hashes are its fingerprint; two fingerprints estimate the likeness of the
two phrase sets, as a compressor would find shared phrases.
"""

import bisect
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon.llm.text import sliced

SIZE = 64
RANGES_PER_PARTITION = 4

FINGERPRINT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def parse(text: bytes, seen: set[bytes], start: int = 0) -> tuple[list[bytes], list[int]]:
    """The phrases of ``text`` from ``start`` on, given those seen before, and where each of them ends.

    A phrase's beginnings are all phrases too, so the search for its end may start at any length: it
    starts at the length of the last one and moves up or down.
    """
    phrases, ends = [], []
    add, keep, close = seen.add, phrases.append, ends.append
    size = len(text)
    length = 1
    while start < size:
        end = start + length
        phrase = text[start:end]
        if phrase in seen:
            while phrase in seen and end < size:
                end += 1
                phrase = text[start:end]
        else:
            while length > 1:
                shorter = text[start : end - 1]
                if shorter in seen:
                    break
                phrase = shorter
                end -= 1
                length -= 1
        add(phrase)
        keep(phrase)
        length = len(phrase)
        start += length
        close(start)
    return phrases, ends


def smallest(phrases: set[bytes]) -> np.ndarray:
    """The smallest hashes of the phrase set, ascending."""
    hashes = np.fromiter(map(zlib.crc32, phrases), np.uint32, len(phrases))
    hashes *= np.uint32(0x9E3779B1)  # one-to-one, and spreads the checksums of short phrases
    hashes ^= hashes >> np.uint32(15)
    hashes *= np.uint32(0x85EBCA6B)
    if len(hashes) > SIZE:
        hashes = np.partition(hashes, SIZE)[:SIZE]
    return np.sort(hashes)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases, from the smallest hashes of both sets together."""
    if not len(a) and not len(b):
        return 1.0
    union = np.union1d(a, b)[:SIZE]
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, common, assume_unique=True).sum()) / len(union)


def text_of(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


class Parsed:
    """A text with its phrases and their ends; phrases are of UTF-8 bytes."""

    def __init__(self, text: str):
        self.text = text
        found: set[bytes] = set()
        self.phrases, self.ends = parse(text.encode(), found)
        self.sketch = smallest(found)

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        """The text with its second half replaced by the start of the next, and its fingerprint.

        Both parses agree on all phrases that end within the first half, so these are taken over.
        """
        cut = len(self.text) // 2
        kept = self.text[: len(self.text) - cut]
        edited = kept + following[:cut]
        common = bisect.bisect_right(self.ends, len(kept.encode()))
        found = set(self.phrases[:common])
        parse(edited.encode(), found, self.ends[common - 1] if common else 0)
        return edited, smallest(found)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Consecutive rows of a run: ``(run, own, doc_id, text)`` with the row behind it."""
    before = None
    for batch in sliced(batches):
        rows = zip(*(batch.column(c).to_pylist() for c in ("run", "own", "doc_id", "text")), strict=True)
        for row in rows:
            if before is not None:
                yield before, row
            before = row
    if before is not None:
        yield before, None


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    size = 0
    ready: Parsed | None = None
    for (run, own, doc, text), following in _pairs(batches):
        if not own:
            ready = None
            continue
        here = ready or Parsed(text or "")
        ready = None
        if following is not None and following[0] == run:
            ready = Parsed(following[3] or "")
            after = ready
        else:
            after = here  # the only document of its table
        edited, sketch = here.edited(after.text)
        rows.append(
            (
                doc,
                len(here.text),
                hashlib.sha256(edited.encode()).hexdigest(),
                text_of(here.sketch),
                text_of(sketch),
                likeness(here.sketch, sketch),
                likeness(here.sketch, after.sketch),
            )
        )
        size += 1
        if size == 2000:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in FINGERPRINT.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def runs_with_neighbours(documents: DataFrame) -> DataFrame:
    """Rows sorted by ``doc_id`` in runs, each with a copy of the first row behind it.

    The runs are ranges of ids with about equally many rows. The last one ends with the first row of
    all, so every row's next one lies in its run. One exchange moves every text once and one text per
    run twice. Only the bounds of the runs reach the driver; their number follows the shuffle width.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / (width * RANGES_PER_PARTITION) for i in range(1, width * RANGES_PER_PARTITION)]
    # A bound is an id that occurs, and its rows start a run; the first row of all starts run 0.
    found = texts.agg(
        F.percentile_approx("doc_id", shares, 100 * len(shares)).alias("bounds"),
        F.min("doc_id").alias("lowest"),
        F.max(F.col("doc_id").isNull()).alias("nulls"),
    ).first()
    first = None if found.nulls else found.lowest
    bounds = sorted(set(found.bounds or []) - {first})

    edges = F.array(*(F.lit(b).cast("long") for b in bounds)) if bounds else F.array().cast("array<long>")
    run = F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.size(F.filter(edges, lambda edge: edge <= F.col("doc_id")))
    )
    placed = texts.withColumn("run", run)
    # Rows that share the id of a bound: all come as copies, and the smallest text is used.
    opens = F.coalesce(F.array_contains(edges, F.col("doc_id")), F.lit(False))
    is_first = F.col("doc_id").eqNullSafe(F.lit(first).cast("long"))
    copies = (
        F.when(opens & is_first, F.array(F.col("run") - 1, F.lit(len(bounds))))
        .when(opens, F.array(F.col("run") - 1))
        .when(is_first, F.array(F.lit(len(bounds))))
        .otherwise(F.array().cast("array<int>"))
    )
    own = F.array(F.struct(F.col("run"), F.lit(True).alias("own")))
    copied = F.transform(copies, lambda r: F.struct(r.alias("run"), F.lit(False).alias("own")))
    rows = placed.select("doc_id", "text", F.explode(F.concat(own, copied)).alias("at"))
    return rows.select("at.run", "at.own", "doc_id", "text")


def fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness.

    The edited text has the last half of the characters replaced by the start of the next document's
    text in ascending order of ``doc_id``; the first follows the last. Null text is empty; two texts
    without phrases are alike (1). Null ids come first, rows that share an id are ordered by text. A
    single document is its own next one. An empty table gives no rows; further columns are ignored.
    """
    if documents.isEmpty():
        return documents.sparkSession.createDataFrame([], FINGERPRINT)
    width = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = runs_with_neighbours(documents).repartition(width, "run")
    # Within a run the own rows come first, in order; of the copies behind them the first one counts.
    ordered = placed.sortWithinPartitions("run", F.col("own").desc(), F.col("doc_id"), "text")
    return ordered.mapInArrow(_fingerprints, FINGERPRINT)
