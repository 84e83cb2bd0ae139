"""Removal of passages that an earlier document holds too, by FM-indexes over shards of passages.

A window is 50 consecutive words. Every window has an anchor, the smallest hash among its runs of eight
words, and equal windows have equal anchors. Anchors that one document alone has are dropped. For the
rest, the stretch of text around each anchor goes to the shard of its anchor, so that windows meet
wherever they are equal and nowhere else. There an FM-index is built over the distinct stretches, and
each of them is streamed through it by backward search; the matches of 50 words or more give the smallest
document that holds each window.

Equal stretches are combined before any of this, so thousands of copies cost one. An anchor with very
many different stretches is taken apart: its windows are combined one by one under anchors of their own.
"""

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon.llm.fm_index import FmIndex
from sparkmon.llm.text import WordCodes, gram_codes, offsets, sliced, utf8
from sparkmon.session import broadcast_if_small, scratch, stage

WINDOW = 50
GRAM = 8
RUN = 256
SHARD_WORDS = 300_000
#: Stretches of one anchor beyond which its windows are combined one by one.
CROWDED = 8_000

ANCHOR = "doc_id long, text_hash long, bucket long, start int, n int"
PACKED = "doc_id long, text_hash long, packed binary"
STRETCH = "doc_id long, text_hash long, bucket long, start int, key binary, words binary"
ANSWER = "bucket long, key binary, found array<struct<at: int, n: int, doc: long>>"
SINGLE = "bucket long, key binary, at int, window_bucket long, window_key binary, words binary, low long"
REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
KEY = ["doc_id", "text_hash"]


def window_anchors(codes: np.ndarray, counts: list[int]) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts laid end to end: text, first window, windows, anchor."""
    starts = offsets(counts)
    grams = gram_codes(codes, GRAM)
    span, width = 1, WINDOW - GRAM + 1
    lowest = grams
    while 2 * span <= width:
        lowest = np.minimum(lowest[:-span], lowest[span:]) if len(lowest) > span else lowest[:0]
        span *= 2
    rest = width - span
    if rest:
        lowest = np.minimum(lowest[:-rest], lowest[rest:]) if len(lowest) > rest else lowest[:0]
    sizes = np.maximum(np.diff(starts) - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(counts)), sizes)
    inner = np.arange(len(owner)) - np.repeat(offsets(sizes)[:-1], sizes)
    anchor = lowest[starts[owner] + inner]
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (np.diff(owner) != 0) | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(fresh)
    # Texts that repeat themselves have very long runs; these are cut.
    place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    first = np.flatnonzero(place % RUN == 0)
    n = np.diff(np.append(first, len(owner)))
    return owner[first], inner[first], n, anchor[first]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = WordCodes()
    for batch in sliced(batches):
        texts = [text.split() for text in utf8(batch.column("text"))]
        codes = memo.codes(list(itertools.chain.from_iterable(texts)))
        owner, start, n, anchor = window_anchors(codes, [len(words) for words in texts])
        rows = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(rows),
                batch.column("text_hash").take(rows),
                pa.array(anchor.view(np.int64)),
                pa.array(start.astype(np.int32)),
                pa.array(n.astype(np.int32)),
            ],
            names=["doc_id", "text_hash", "bucket", "start", "n"],
        )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in sliced(batches):
        packed = [pack(text) for text in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(packed, pa.binary())],
            names=["doc_id", "text_hash", "packed"],
        )


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in sliced(batches, "packed"):
        yield batch, [unpack(text).split() for text in batch.column("packed").to_pylist()]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in _unpacked(batches):
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "runs"))
        for doc, text_hash, runs, words in zip(*columns, texts, strict=True):
            for run in runs:
                start, n = run["start"], run["n"]
                stretch = b" ".join(words[start : start + n + WINDOW - 1])
                rows.append(
                    (doc, text_hash, run["bucket"], start, xxhash.xxh3_128_digest(stretch), stretch)
                )
        yield _rows(rows, STRETCH)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kinds[kind]) for column, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def shard_answers(shard: list[tuple]) -> pa.RecordBatch:
    """For the ``bucket, key, words, low`` rows of a shard, the smallest document of every window."""
    sequences = [words.split(b" ") for _, _, words, _ in shard]
    index = FmIndex(sequences, WINDOW)
    matched, rows = index.matches(index.coded)
    lows = np.array([low for *_, low in shard], np.int64)
    counts = index.lengths - WINDOW + 1
    owner = np.repeat(np.arange(len(shard)), counts)
    inner = np.arange(len(owner)) - np.repeat(offsets(counts)[:-1], counts)
    place = offsets(index.lengths)[owner] + inner
    smallest = np.where(
        matched[place] >= WINDOW, index.smallest_owner(lows, rows[place]), lows[owner]
    )
    fresh = np.ones(len(owner), bool)
    fresh[1:] = (np.diff(owner) != 0) | (np.diff(smallest) != 0)
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(owner)))
    found = pa.StructArray.from_arrays(
        [
            pa.array(inner[first].astype(np.int32)),
            pa.array(n.astype(np.int32)),
            pa.array(smallest[first]),
        ],
        names=["at", "n", "doc"],
    )
    ends = np.searchsorted(owner[first], np.arange(len(shard) + 1)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([bucket for bucket, *_ in shard], pa.int64()),
            pa.array([key for _, key, *_ in shard], pa.binary()),
            pa.ListArray.from_arrays(pa.array(ends), found),
        ],
        names=["bucket", "key", "found"],
    )


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; a shard holds whole buckets of about ``SHARD_WORDS`` words."""
    shard: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("bucket", "key", "words", "low"))
        for row in zip(*columns, strict=True):
            if size >= SHARD_WORDS and row[0] != last:
                yield shard_answers(shard)
                shard, size = [], 0
            shard.append(row)
            size += row[2].count(b" ") + 2
            last = row[0]
    if shard:
        yield shard_answers(shard)


def answers(stretches: DataFrame) -> DataFrame:
    """``bucket, key, found`` for distinct ``bucket, key, words, low`` rows."""
    width = int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stretches.select("bucket", "key", "words", "low").repartition(width, "bucket")
    return placed.sortWithinPartitions("bucket").mapInArrow(_answers, ANSWER)


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "words"):
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("bucket", "key", "words", "low"))
        for bucket, key, stretch, low in zip(*columns, strict=True):
            words = stretch.split(b" ")
            for at in range(len(words) - WINDOW + 1):
                window = b" ".join(words[at : at + WINDOW])
                digest = xxhash.xxh3_128_digest(window)
                own = int.from_bytes(digest[:8], "little", signed=True)
                rows.append((bucket, key, at, own, digest, window, low))
        yield _rows(rows, SINGLE)


def crowded_answers(stretches: DataFrame) -> DataFrame:
    """The same as :func:`answers` for anchors with very many stretches, window by window.

    Equal windows are combined first, so a shard gets each window once, however many stretches hold it.
    """
    windows = stage(stretches.mapInArrow(_single_windows, SINGLE), "windows")
    distinct = windows.groupBy(
        F.col("window_bucket").alias("bucket"), F.col("window_key").alias("key"), "words"
    ).agg(F.min("low").alias("low"))
    found = answers(distinct).select(
        F.col("bucket").alias("window_bucket"),
        F.col("key").alias("window_key"),
        F.col("found")[0]["doc"].alias("doc"),
    )
    each = windows.drop("words").join(found, ["window_bucket", "window_key"])
    return each.groupBy("bucket", "key").agg(
        F.collect_list(F.struct("at", F.lit(1).alias("n"), "doc")).alias("found")
    )


def kept_words(words: list[bytes], spans: list[dict]) -> list[bytes]:
    """The words outside all windows of the spans."""
    covered = np.zeros(len(words) + 1, np.int64)
    start = np.array([span["start"] for span in spans])
    end = start + np.array([span["n"] for span in spans]) + WINDOW - 1
    np.add.at(covered, start, 1)
    np.add.at(covered, end, -1)
    return list(itertools.compress(words, (np.cumsum(covered[:-1]) == 0).tolist()))


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in _unpacked(batches):
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "spans"))
        for doc, spans, words in zip(*columns, texts, strict=True):
            kept = kept_words(words, spans) if spans else words
            text = b" ".join(kept)
            rows.append((doc, len(words), len(words) - len(kept), hashlib.sha256(text).hexdigest(), text))
        yield _rows(rows, REPORT.replace("kept_text string", "kept_text binary")).cast(_report_schema())


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        spans = batch.column("_spans").to_pylist()
        columns = {name: batch.column(name) for name in batch.schema.names if name != "_spans"}
        texts = columns["text"].to_pylist()
        sizes = columns["n_chars"].to_pylist() if "n_chars" in columns else []
        stays = [True] * len(texts)
        for row, found in enumerate(spans):
            if found:
                texts[row] = b" ".join(kept_words(texts[row].encode().split(), found)).decode()
                stays[row] = bool(texts[row])
                if sizes:
                    sizes[row] = len(texts[row])
        columns["text"] = pa.array(texts, columns["text"].type)
        if sizes:
            columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
        cleaned = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        yield cleaned.filter(pa.array(stays))


def _report_schema() -> pa.Schema:
    return pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
        + [("kept_sha256", pa.string()), ("kept_text", pa.string())]
    )


def keyed_texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )


def repeated_spans(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, spans``: windows that a document with a smaller id holds too."""
    with scratch(documents.sparkSession):
        texts = keyed_texts(documents).filter("doc_id is not null and text is not null")
        anchors = stage(texts.mapInArrow(_anchors, ANCHOR), "anchors")
        bounds = anchors.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        common = stage(bounds.filter("low < high").select("bucket"), "common-anchors")
        runs = (
            anchors.join(broadcast_if_small(common), "bucket", "left_semi")
            .groupBy(*KEY)
            .agg(F.collect_list(F.struct("start", "n", "bucket")).alias("runs"))
        )
        runs = stage(runs, "runs")
        packed = texts.mapInArrow(_pack, PACKED)
        cut = packed.join(broadcast_if_small(runs), KEY).mapInArrow(_stretches, STRETCH)
        stretches = stage(cut, "stretches")
        distinct = stretches.groupBy("bucket", "key", "words").agg(
            F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
        )
        distinct = stage(distinct, "distinct-stretches")
        crowded = stage(
            distinct.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > CROWDED).select("bucket"),
            "crowded",
        )
        found = answers(distinct.join(broadcast_if_small(crowded), "bucket", "left_anti"))
        if not crowded.isEmpty():
            apart = distinct.join(broadcast_if_small(crowded), "bucket", "left_semi")
            found = found.unionByName(crowded_answers(apart))
        found = stage(found, "answers")
        # Only the rows of a stretch from documents behind its window's first one lose anything.
        hits = (
            stretches.select(*KEY, "bucket", "start", "key")
            .join(found, ["bucket", "key"])
            .select(*KEY, "start", F.explode("found").alias("f"))
            .filter("f.doc < doc_id")
            .select(*KEY, F.struct((F.col("start") + F.col("f.at")).alias("start"), F.col("f.n").alias("n")).alias("s"))
        )
        spans = hits.groupBy(*KEY).agg(F.collect_list("s").alias("spans"))
        return stage(spans, "spans", outlives=True)


def without_repeats(documents: DataFrame) -> DataFrame:
    """Per document its words, the words removed, and the rest as text with its checksum.

    A word goes if any of its windows also starts in a document with a smaller ``doc_id``; windows are
    judged on the input. Words are kept unchanged and joined by one space. Null and empty texts have no
    words. Rows with a null id take no part and keep everything. Rows that share an id are judged each by
    its own text and don't remove from one another. An empty table gives no rows; further columns are
    ignored.
    """
    spans = repeated_spans(documents)
    packed = keyed_texts(documents).mapInArrow(_pack, PACKED)
    joined = packed.join(broadcast_if_small(spans), KEY, "left").select("doc_id", "packed", "spans")
    return joined.mapInArrow(_report, REPORT)


def cleaned_documents(documents: DataFrame) -> DataFrame:
    """The documents with the repeated passages taken out, all columns kept.

    A text that loses words becomes its kept words joined by one space, and ``n_chars``, if there, is
    counted anew. A document of which nothing is left goes. All other rows stay as they are.
    """
    spans = repeated_spans(documents).withColumnRenamed("spans", "_spans")
    same = (documents["doc_id"].cast("long") == spans["doc_id"]) & (
        F.xxhash64(documents["text"].cast("string")) == spans["text_hash"]
    )
    columns = [documents[c] for c in documents.columns]
    joined = documents.join(broadcast_if_small(spans), same, "left").select(*columns, spans["_spans"])
    return joined.mapInArrow(_cleaned, documents.schema)
