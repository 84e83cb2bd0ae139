"""Best-fit packing of documents into sequences by patterns of lengths.

The plan depends on the histogram of piece lengths alone, which has at most as many rows as a sequence
has tokens. Non-negative least squares chooses how often to repeat each pattern of up to four length
classes so that together they use up the histogram; the counts are rounded and realised with lengths that fill a
sequence exactly, and what is left over is packed best fit, longest first. Pieces then find their sequence from their
number among the pieces of equal length, which costs no exchange of texts.
"""

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmon.llm.text import sliced
from sparkmon.llm.tokens import encoder
from sparkmon.session import stage

CAPACITY = 2048
CLASSES = 64
PATTERN_SIZE = 4
#: Shares of the fitted repeats to try: what is left over keeps lengths of every size to fill gaps with.
PATTERN_SHARES = (0.8, 0.4, 0.2, 0.1, 0.05, 0.02, 0.0)

PIECE = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, number long"
PACKED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)


def nnls(matrix: np.ndarray, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares by an active set."""
    solution = np.zeros(matrix.shape[1])
    active: list[int] = []
    scale = max(1.0, float(np.abs(target).max()))
    for _ in range(rounds):
        gradient = matrix.T @ (target - matrix @ solution)
        gradient[active] = -np.inf
        best = int(np.argmax(gradient))
        if gradient[best] <= 1e-9 * scale:
            break
        active.append(best)
        while True:
            trial = np.linalg.lstsq(matrix[:, active], target, rcond=None)[0]
            if (trial > 0).all():
                break
            now = solution[active]
            down = trial <= 0
            step = np.min(now[down] / np.maximum(now[down] - trial[down], 1e-300))
            now = now + step * (trial - now)
            solution[active] = now
            keep = now > 1e-12 * scale
            if keep.all():
                keep[np.flatnonzero(down)[0]] = False
            for index, kept in zip(active, keep, strict=True):
                solution[index] = solution[index] if kept else 0.0
            active = [i for i, kept in zip(active, keep, strict=True) if kept]
            if not active:
                break
        solution[active] = trial if active else []
    return solution


def patterns() -> np.ndarray:
    """Multisets of up to ``PATTERN_SIZE`` length classes that fill a sequence."""
    found = []

    def extend(chosen: tuple[int, ...], room: int) -> None:
        if room == 0:
            found.append(chosen)
        elif len(chosen) < PATTERN_SIZE:
            most = min(room, chosen[-1] if chosen else CLASSES)
            least = -(-room // (PATTERN_SIZE - len(chosen)))
            for size in range(least, most + 1):
                extend((*chosen, size), room - size)

    extend((), CLASSES)
    counts = np.zeros((CLASSES, len(found)))
    for column, chosen in enumerate(found):
        for size in chosen:
            counts[size - 1, column] += 1
    return counts


class Lengths:
    """The histogram while it is used up."""

    def __init__(self, histogram: np.ndarray):
        self.left = histogram.astype(np.int64).copy()
        self.left[0] = 0

    def fits(self, room: int, used: dict[int, int]) -> int:
        """The longest length within ``room`` that is still left beside those used; 0 if none."""
        room = min(room, len(self.left) - 1)
        lengths = np.flatnonzero(self.left[: room + 1])[::-1]
        return next((int(n) for n in lengths if self.left[n] > used.get(int(n), 0)), 0)

    def filling(self, tops: list[int], width: int) -> dict[int, int]:
        """Lengths left from classes of ``width`` below the tops that fill a sequence exactly, if any.

        All but the last two are the longest of their classes; of the last two, every pair that sums up to
        what is left is as good, and the first one found is taken.
        """
        room = len(self.left) - 1
        used: dict[int, int] = {}
        for top in tops[:-2]:
            length = self.fits(min(top, room), used)
            if length <= top - width:
                return {}
            used[length] = used.get(length, 0) + 1
            room -= length
        for first in range(min(tops[-2:][0], room), max(0, tops[-2:][0] - width), -1):
            last = room - first
            pair = [n for n in (first, last) if n]
            wanted = used.copy()
            for n in pair:
                wanted[n] = wanted.get(n, 0) + 1
            if all(self.left[n] >= k for n, k in wanted.items()):
                return wanted
        return {}

    def take(self, used: dict[int, int], most: int) -> int:
        """Take the lengths as often as they are left, ``most`` times at most."""
        times = min([most, *(int(self.left[n]) // k for n, k in used.items())])
        for n, k in used.items():
            self.left[n] -= times * k
        return times


class Sequences:
    """Groups of equal sequences by the room that is left in them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(capacity + 1)]

    def add(self, repeats: int, chosen: tuple[int, ...]) -> None:
        if repeats:
            self.by_room[self.capacity - sum(chosen)].append((repeats, chosen))

    def place(self, length: int, pieces: int) -> None:
        """Put each piece where the least room is left, or into a new sequence."""
        room = length
        while pieces and room <= self.capacity:
            if not self.by_room[room]:
                room += 1
                continue
            repeats, chosen = self.by_room[room].pop()
            most = room // length  # as many in each as fit, which is what comes next anyway
            full, rest = divmod(min(pieces, repeats * most), most)
            self.add(full, chosen + (length,) * most)
            if rest:
                self.add(1, chosen + (length,) * rest)
            self.add(repeats - full - (rest > 0), chosen)
            pieces -= full * most + rest
        if pieces:
            most = self.capacity // length
            self.add(pieces // most, (length,) * most)
            self.add(1 if pieces % most else 0, (length,) * (pieces % most))

    def rows(self) -> list[tuple[int, tuple[int, ...]]]:
        return [row for group in self.by_room for row in group]


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """``(repeats, lengths)`` rows that use up the histogram (index: length) in the fewest sequences found.

    The fit is made once and realised by each share; of equally good ones the largest share is taken. No
    plan can have fewer sequences than all tokens fill, so the search ends when one has as few.
    """
    width = -(-capacity // CLASSES)
    classes = -(-np.arange(len(histogram)) // width)
    matrix = patterns()
    mixed = np.arange(1, capacity)  # full pieces have their own sequences
    target = np.bincount(classes[mixed], weights=histogram[mixed], minlength=CLASSES + 1)[1:]
    fit = nnls(matrix, target)
    least = -(-int((histogram * np.arange(len(histogram))).sum()) // capacity)
    best: list[tuple[int, tuple[int, ...]]] = []
    fewest = None
    for share in PATTERN_SHARES:
        rows = realised(histogram, matrix, np.floor(share * fit).astype(np.int64), capacity)
        count = sum(repeats for repeats, _ in rows)
        if fewest is None or count < fewest:
            best, fewest = rows, count
        if fewest <= least:
            break
    return best


def realised(
    histogram: np.ndarray, matrix: np.ndarray, repeats: np.ndarray, capacity: int
) -> list[tuple[int, tuple[int, ...]]]:
    """Sequences by the repeats of each pattern as far as lengths are left, then the rest by best fit.

    Every row exhausts a pattern's repeats, a length or a group of sequences, so their number is bounded by
    the capacity and the number of patterns, whatever the size of the corpus.
    """
    lengths = Lengths(histogram)
    sequences = Sequences(capacity)
    sequences.add(lengths.take({capacity: 1}, int(lengths.left[capacity])), (capacity,))
    width = -(-capacity // CLASSES)
    for column in np.argsort(-repeats, kind="stable"):
        most = int(repeats[column])
        sizes = np.flatnonzero(matrix[:, column]) + 1
        wanted = [int(c) for c in sizes[::-1] for _ in range(int(matrix[c - 1, column]))]
        while most > 0 and (used := lengths.filling([size * width for size in wanted], width)):
            times = lengths.take(used, most)
            sequences.add(times, tuple(n for n, k in used.items() for _ in range(k)))
            most -= times
    # What rounding and missing lengths leave over, longest first.
    for length in range(capacity - 1, 0, -1):
        sequences.place(length, int(lengths.left[length]))
    return sequences.rows()


class Places:
    """Where the n-th piece of each length goes, as runs sorted by first number."""

    def __init__(self, rows: list[tuple[int, tuple[int, ...]]]):
        runs: dict[int, list[tuple]] = {}
        numbered: dict[int, int] = {}
        sequence = 0
        for repeats, chosen in rows:
            starts = [0, *itertools.accumulate(chosen)]
            offsets: dict[int, list[int]] = {}
            for start, length in zip(starts, chosen, strict=False):
                offsets.setdefault(length, []).append(start)
            for length, places in offsets.items():
                first = numbered.get(length, 0)
                runs.setdefault(length, []).append((first, sequence, np.array(places)))
                numbered[length] = first + repeats * len(places)
            sequence += repeats
        self.runs = {n: (np.array([r[0] for r in found]), found) for n, found in runs.items()}
        self.sequences = sequence

    def find(self, length: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        firsts, found = self.runs[length]
        run = np.searchsorted(firsts, numbers, "right") - 1
        sequences, offsets = np.empty(len(numbers), np.int64), np.empty(len(numbers), np.int64)
        for r in np.unique(run):
            mine = run == r
            first, sequence, places = found[r]
            sequences[mine] = sequence + (numbers[mine] - first) // len(places)
            offsets[mine] = places[(numbers[mine] - first) % len(places)]
        return sequences, offsets


def _cut(path: str, mark: str, spaced: bool, end_id: int, capacity: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        memo = encoder(path, mark, spaced)
        seen = [0] * (capacity + 1)
        for batch in sliced(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            rows = []
            for doc, found in zip(batch.column("doc_id").to_pylist(), memo.encode(texts), strict=True):
                ids = found + end
                total = len(ids) // 4
                first = total % capacity or capacity  # the first piece takes what is left over
                starts = [0, *range(first, total, capacity)]
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], total], strict=True)):
                    rows.append((doc, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), part, seen[b - a]))
                    seen[b - a] += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            names = [field.split()[0] for field in PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=names
            )

    return run


def _place(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            numbers = batch.column("number").to_numpy()
            sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                if len(mine):
                    sequences[mine], offsets[mine] = places.find(int(lengths[mine[0]]), numbers[mine])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "piece", "start")),
                    batch.column("length").cast(pa.int64()),
                    batch.column("ids_crc32"),
                    pa.array(sequences),
                    pa.array(offsets),
                ],
                names=[field.split()[0] for field in PACKED.split(", ")],
            )

    return run


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    mark: str,
    spaced: bool,
    end_id: int,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece with its sequence and its place there.

    Each document is its ids and ``end_id``. One longer than ``capacity`` is cut into pieces of that
    size, of which the first takes what is left over. Null text is empty and packs its end id alone;
    null or repeated ids stay as they are; an empty table packs nothing; further columns are ignored.
    The driver sees the histogram of lengths; the counts per task and length that number the pieces
    stay in Spark.
    """
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    pieces = stage(texts.mapInArrow(_cut(vocabulary, mark, spaced, end_id, capacity), PIECE), "pieces")
    counts = stage(
        pieces.groupBy("part", "length").agg(F.count("*").alias("pieces")), "piece-counts"
    )
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect():
        histogram[row.length] = row.pieces
    shared = documents.sparkSession.sparkContext.broadcast(Places(plan(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "part", "length", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("base")
    )
    numbered = pieces.join(bases, ["part", "length"]).withColumn("number", F.expr("base + number"))
    return numbered.select(*(f.split()[0] for f in PIECE.split(", "))).mapInArrow(_place(shared), PACKED)
