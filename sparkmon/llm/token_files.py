"""Token-id files with directly addressable codes.

Documents are sorted by id and cut into segments. A segment stores its ids in chunks of eight bits, one
level per chunk: level 0 has the low chunk of every id, and a bitmap marks the ids that go on in level
1, and so on. A rank directory over each bitmap (a count before every block of 512 bits) turns "this id
goes on" into its place in the next level, so any id is read without decoding its neighbours.

A segment is one binary value of a Parquet row. Spark writes and reads those rows, so the files can lie
in any store that Spark reaches, and a lost task is simply written again.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmon.llm.text import sliced
from sparkmon.llm.tokens import encoder

SEGMENT_IDS = 1 << 18
CHUNK = 8
BLOCK = 512
HEADER = struct.Struct("<4sIQI")
MAGIC = b"DAC1"

SEGMENT = (
    "part int, segment int, n_ids long, ids_before long, doc_ids array<long>, ends array<long>, codes binary"
)
DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def pack(ids: np.ndarray) -> bytes:
    """The ids as levels of chunks with bitmaps and rank directories."""
    rest = ids.astype(np.uint32)
    levels = []
    while True:
        more = rest >> CHUNK
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, BLOCK // 8).sum(axis=1)
        ranks = np.concatenate(([0], np.cumsum(ones))).astype("<u4")
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8), ranks, bits))
        if not goes_on.any():
            break
        rest = more[goes_on]
    out = [HEADER.pack(MAGIC, len(levels), len(ids), 0)]
    out += [struct.pack("<QII", n, len(ranks), len(bits)) for n, _, ranks, bits in levels]
    for _, chunks, ranks, bits in levels:
        out += [ranks.tobytes(), bits.tobytes(), chunks.tobytes()]
    return b"".join(out)


class Codes:
    """Reads packed ids in place."""

    def __init__(self, packed: bytes):
        magic, levels, self.size, _ = HEADER.unpack_from(packed)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at = HEADER.size
        shapes = []
        for _ in range(levels):
            shapes.append(struct.unpack_from("<QII", packed, at))
            at += 16
        self.levels = []
        for size, n_ranks, n_bits in shapes:
            ranks = np.frombuffer(packed, "<u4", n_ranks, at)
            bits = np.frombuffer(packed, np.uint8, n_bits, at + 4 * n_ranks)
            at += 4 * n_ranks + n_bits
            self.levels.append((np.frombuffer(packed, np.uint8, size, at), ranks, bits))
            at += size

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, place: int) -> int:
        """One id, by a rank per level."""
        if not 0 <= place < self.size:
            raise IndexError(place)
        value = 0
        for depth, (chunks, ranks, bits) in enumerate(self.levels):
            value |= int(chunks[place]) << (CHUNK * depth)
            if not bits[place >> 3] >> (place & 7) & 1:
                break
            block = place // BLOCK
            before = bits[block * (BLOCK // 8) : place >> 3]
            part = int(bits[place >> 3]) & ((1 << (place & 7)) - 1)
            place = int(ranks[block]) + int(np.bitwise_count(before).sum()) + part.bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        values = np.zeros(self.size, np.uint32)
        places = np.arange(self.size)
        for depth, (chunks, _, bits) in enumerate(self.levels):
            values[places] |= chunks.astype(np.uint32) << np.uint32(CHUNK * depth)
            goes_on = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            places = places[goes_on]
        return values


def _segments(path: str, mark: str, spaced: bool, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        memo = encoder(path, mark, spaced)
        docs, held, size, before = [], [], 0, 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            ends = np.cumsum([len(ids_of) // 4 for ids_of in held])
            row = [[part], [number], [len(ids)], [before], [docs], [ends.tolist()], [pack(ids)]]
            types = [*[pa.int32()] * 2, *[pa.int64()] * 2, *[pa.list_(pa.int64())] * 2, pa.binary()]
            names = ["part", "segment", "n_ids", "ids_before", "doc_ids", "ends", "codes"]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, types, strict=True)], names=names
            )

        for batch in sliced(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            ids = memo.encode(texts)
            for doc, found in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
                docs.append(doc)
                held.append(found + end)
                size += len(found) // 4 + 1
                if size >= SEGMENT_IDS:
                    yield segment()
                    before += size
                    docs, held, size, number = [], [], 0, number + 1
        if docs:
            yield segment()

    return run


def write_ids(
    documents: DataFrame, path: str, vocabulary: str, mark: str, spaced: bool, end_id: int
) -> None:
    """Encode the documents and write their ids to ``path`` in ascending order of ``doc_id``.

    One exchange sorts the texts by id; they are encoded behind it. Null text is empty, a null
    ``doc_id`` sorts first, rows that share an id are ordered by text, and further columns are ignored.
    An empty table writes no segment. A document is never divided between segments.
    """
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    width = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = texts.repartitionByRange(width, "doc_id").sortWithinPartitions("doc_id", "text")
    segments = ordered.mapInArrow(_segments(vocabulary, mark, spaced, end_id), SEGMENT)
    segments.write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``base``, the number of ids in all segments before each.

    Parts are numbered in the order of ids, so the base is a sum over the totals of the parts before plus
    the count that each segment keeps of its own part. There are as many parts as the write had tasks,
    which bounds the broadcast.
    """
    segments = spark.read.schema(SEGMENT).parquet(path)
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("part_base"))
    return segments.join(F.broadcast(parts), "part").withColumn("base", F.expr("part_base + ids_before"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, docs, ends, packed in zip(
            *(batch.column(c).to_pylist() for c in ("base", "doc_ids", "ends", "codes")), strict=True
        ):
            ids = Codes(packed).all().astype("<u4").tobytes()
            starts = [0, *ends[:-1]]
            crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array([base + a for a in starts], pa.int64()),
                    pa.array([b - a for a, b in zip(starts, ends, strict=True)], pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document its first place among all ids, its number of ids and their checksum."""
    segments = read_segments(spark, path).select("base", "doc_ids", "ends", "codes")
    return segments.mapInArrow(_documents, DOCUMENT)
