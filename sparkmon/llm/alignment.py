"""Alignment of two tokenizers: groups of ids that cover the same bytes, and counts of linked ids.

The ends of both token sequences are byte offsets. A common end near the middle of an interval is found by
bisection and splits it; both halves go on alike, and an interval without a common end inside is a group.
All intervals of a slice of texts go through their rounds together, one numpy step per round.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon.llm.text import SLICE_BYTES, offsets, sliced
from sparkmon.llm.tokens import encoder
from sparkmon.session import stage

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"
COUNTED = "pair long, n long"
#: Neighbours of the middle that are tried one by one before the whole interval is bisected.
NEAR = 6
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
COMMA, BAR, SEMICOLON = 0, 1, 2


def piece_bytes(piece: str) -> bytes:
    """Bytes of a sentence piece: a byte piece is its byte, U+2581 a space."""
    found = BYTE_PIECE.fullmatch(piece)
    return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()


class Pair:
    """Both tokenizers, the bytes of their entries and the decimal text of their ids."""

    def __init__(self, path_a: str, mark_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.ranks = encoder(path_a, mark_a, True)
        self.pieces = SentencePieceProcessor(model_file=path_b)
        size_a, size_b = self.ranks.tokenizer.get_vocab_size(), self.pieces.get_piece_size()
        self.bytes_a = [self.ranks.bytes_of.get(i, b"") for i in range(size_a)]
        self.bytes_b = [piece_bytes(self.pieces.id_to_piece(i)) for i in range(size_b)]
        self.lengths_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.lengths_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.size = max(size_a, size_b)
        self.shown = [f"{i}{mark}" for mark in ",|;" for i in range(self.size)]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both tokenizers; none for texts that one of them does not reproduce."""
        held = [text or "" for text in texts]
        none = np.empty(0, np.int64)
        ids_a, ids_b = [], []
        for text, b in zip(held, self.pieces.encode(held, num_threads=1), strict=True):
            # What looks like a special token is plain text on both sides.
            a = self.ranks.plain_ids(" " + text)
            data = b" " + text.encode()
            whole = (
                text != ""
                and b"".join(map(self.bytes_a.__getitem__, a)) == data
                and b"".join(map(self.bytes_b.__getitem__, b)) == data
            )
            ids_a.append(np.array(a, np.int64) if whole else none)
            ids_b.append(np.array(b, np.int64) if whole else none)
        return ids_a, ids_b


_PAIRS: dict[tuple[str, str, str], Pair] = {}


def tokenizer_pair(path_a: str, mark_a: str, path_b: str) -> Pair:
    """One pair per Python worker."""
    key = (path_a, mark_a, path_b)
    if key not in _PAIRS:
        _PAIRS[key] = Pair(*key)
    return _PAIRS[key]


def _bisect(ends_a: np.ndarray, ends_b: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in ``ends_b`` of each end ``ends_a[at]``, and whether it is there."""
    place = np.searchsorted(ends_b, ends_a[at])
    return place, ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[at]


def _cut_near_middle(
    ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each interval of inner ends ``low..high`` the common end nearest to its middle, or -1."""
    cut_a, cut_b = np.full(len(low), -1), np.full(len(low), -1)
    middle = (low + high) // 2
    open_ones = np.arange(len(low))
    for step in range(2 * NEAR + 1):
        shift = (step + 1) // 2 * (1 if step % 2 else -1)
        at = middle[open_ones] + shift
        inside = (at >= low[open_ones]) & (at <= high[open_ones])
        tried, at = open_ones[inside], at[inside]
        place, hit = _bisect(ends_a, ends_b, at)
        cut_a[tried[hit]], cut_b[tried[hit]] = at[hit], place[hit]
        open_ones = open_ones[cut_a[open_ones] < 0]
        if not len(open_ones):
            return cut_a, cut_b
    # No common end close by: all inner ends of these intervals are bisected in one step.
    open_ones = open_ones[high[open_ones] - low[open_ones] + 1 > 2 * NEAR]
    if len(open_ones):
        sizes = high[open_ones] - low[open_ones] + 1
        starts = offsets(sizes.tolist())[:-1]
        owner = np.repeat(np.arange(len(open_ones)), sizes)
        at = np.arange(sizes.sum()) - starts[owner] + low[open_ones][owner]
        place, hit = _bisect(ends_a, ends_b, at)
        far = np.where(hit, np.abs(at - middle[open_ones][owner]), np.iinfo(np.int64).max)
        nearest = np.minimum.reduceat(far, starts)
        best = np.flatnonzero(hit & (far == nearest[owner]))
        first = best[np.unique(owner[best], return_index=True)[1]]
        cut_a[open_ones[owner[first]]], cut_b[open_ones[owner[first]]] = at[first], place[first]
    return cut_a, cut_b


def common_ends(
    ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of all common ends in both sequences, in order.

    The sequences hold one or more texts one after another with ascending ends; ``last_a`` and
    ``last_b`` are the places of the texts' last ends, which are common. A stretch without a common
    end is bisected at most three times as a whole: until each side of it is cut off, and as a group.
    """
    found_a, found_b = [last_a], [last_b]
    low_a, low_b = (np.concatenate(([0], last + 1))[:-1] for last in (last_a, last_b))
    high_a, high_b = last_a, last_b
    while True:
        inner = (high_a > low_a) & (high_b > low_b)
        low_a, high_a, low_b, high_b = low_a[inner], high_a[inner], low_b[inner], high_b[inner]
        if not len(low_a):
            break
        cut_a, cut_b = _cut_near_middle(ends_a, ends_b, low_a, high_a - 1)
        cut = cut_a >= 0
        cut_a, cut_b = cut_a[cut], cut_b[cut]
        found_a.append(cut_a)
        found_b.append(cut_b)
        low_a, high_a = np.concatenate((low_a[cut], cut_a + 1)), np.concatenate((cut_a, high_a[cut]))
        low_b, high_b = np.concatenate((low_b[cut], cut_b + 1)), np.concatenate((cut_b, high_b[cut]))
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


def _written(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, pair: Pair) -> list[str]:
    """Ids with the sign behind each, in the order ``a1,a2|b1;a3|b2,b3;``."""
    at_a, at_b = np.arange(len(a)), np.arange(len(b))
    group_a, group_b = np.searchsorted(cut_a, at_a), np.searchsorted(cut_b, at_b)
    b_before = np.concatenate(([0], cut_b + 1))
    codes = np.empty(len(a) + len(b), np.int64)
    codes[at_a + b_before[group_a]] = a + pair.size * np.where(at_a == cut_a[group_a], BAR, COMMA)
    codes[at_b + cut_a[group_b] + 1] = b + pair.size * np.where(at_b == cut_b[group_b], SEMICOLON, COMMA)
    return list(map(pair.shown.__getitem__, codes.tolist()))


def _aligned(path_a: str, mark_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(path_a, mark_a, path_b)
        for batch in sliced(batches, size=SLICE_BYTES // 4):
            ids_a, ids_b = pair.encode(batch.column("text").to_pylist())
            n_a, n_b = np.array(list(map(len, ids_a))), np.array(list(map(len, ids_b)))
            a, b = np.concatenate(ids_a), np.concatenate(ids_b)
            filled = n_a > 0
            last_a, last_b = np.cumsum(n_a)[filled] - 1, np.cumsum(n_b)[filled] - 1
            cut_a, cut_b = common_ends(
                np.cumsum(pair.lengths_a[a]), np.cumsum(pair.lengths_b[b]), last_a, last_b
            )
            shown = _written(a, b, cut_a, cut_b, pair) if len(a) else []
            links = (a[cut_a] * pair.size + b[cut_b]).astype("<u4").tobytes()
            starts = offsets((n_a + n_b).tolist())
            cuts = np.concatenate(([0], np.searchsorted(cut_a, np.cumsum(n_a) - 1, "right")))
            columns = [
                batch.column("doc_id"),
                pa.array(n_a, pa.int64()),
                pa.array(n_b, pa.int64()),
                pa.array(np.diff(cuts), pa.int64()),
                pa.array(np.diff(cuts), pa.int64()),
                pa.array(["".join(shown[s:e])[:-1] for s, e in zip(starts, starts[1:], strict=False)], pa.string()),
                pa.array([links[4 * s : 4 * e] for s, e in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            ]
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def align(documents: DataFrame, path_a: str, mark_a: str, path_b: str) -> DataFrame:
    """Per document its aligned groups, as text ``a1,a2|b1;a3|b2``, and its links.

    ``path_a`` is a byte-level vocabulary that sees a space and the text, ``mark_a`` a special token of it;
    ``path_b`` is a sentence piece model that adds the space itself. A link is an id of each side whose tokens
    end at the same byte; tokens are never empty, so a group has one link. ``links`` holds
    ``a * size + b`` of each in order as little-endian 32-bit integers, where ``size`` is that of the
    larger vocabulary (:func:`pair_size`).

    A null or empty text has no tokens, nor has one that either side does not reproduce byte for byte;
    counts are zero and ``groups`` is empty. Every row counts, also repeated ones and those with a null
    ``doc_id``; further columns are ignored.
    """
    pair_size(path_a, path_b)
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.mapInArrow(_aligned(path_a, mark_a, path_b), ALIGNED)


def pair_size(path_a: str, path_b: str) -> int:
    """Size of the larger vocabulary; a pair of ids has to fit into 32 bits."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    sizes = Tokenizer.from_file(path_a).get_vocab_size(), SentencePieceProcessor(model_file=path_b).get_piece_size()
    if max(sizes) ** 2 > 1 << 32:
        raise ValueError("vocabularies of more than 65,536 entries do not fit into 32-bit pairs")
    return max(sizes)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        held = b"".join(links or b"" for links in batch.column("links").to_pylist())
        new, n = np.unique(np.frombuffer(held, "<u4").astype(np.int64), return_counts=True)
        pairs, place = np.unique(np.concatenate((pairs, new)), return_inverse=True)
        counts = np.bincount(place, np.concatenate((counts, n)), len(pairs)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n)``: how many links of all documents hold each pair of ids.

    Two tokens that end together are one the ending of the other, so a token has at most as many
    partners as it has bytes, times the entries that share their bytes. The number of pairs is thus bounded by
    the vocabularies, about half a million here, whatever the number of documents.
    """
    return aligned.select("links").mapInArrow(_counted, COUNTED).groupBy("pair").agg(F.sum("n").alias("n"))


def pair_scores(aligned: DataFrame, size: int) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to staged rows of :func:`align` and drops the links.

    The counts go to all tasks; their number has the bound that :func:`pair_counts` states.
    """
    spark = aligned.sparkSession
    counts = stage(pair_counts(aligned), "pair-counts").toArrow().sort_by("pair")
    pairs, n = (counts.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
    highest = np.zeros(size, np.int64)
    np.maximum.at(highest, pairs % size, n)
    known = spark.sparkContext.broadcast((pairs.astype(np.uint32), n, n == highest[pairs % size]))
    fields = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = known.value
        for batch in batches:
            held = [links or b"" for links in batch.column("links").to_pylist()]
            starts = offsets([len(links) // 4 for links in held])
            place = np.searchsorted(pairs, np.frombuffer(b"".join(held), "<u4"))
            totals = [np.concatenate(([0], np.cumsum(v[place], dtype=np.int64))) for v in (best, n)]
            columns = [batch.column(c) for c in [*fields, "groups_sha256"]]
            sums = [pa.array(total[starts[1:]] - total[starts[:-1]], pa.int64()) for total in totals]
            yield pa.RecordBatch.from_arrays(
                [*columns, *sums], names=[*fields, "groups_sha256", "n_best", "count_sum"]
            )

    schema = ", ".join(f"{c} long" for c in fields) + ", groups_sha256 string, n_best long, count_sum long"
    return aligned.select(*fields, "groups_sha256", "links").mapInArrow(run, schema)


def alignment_digests(documents: DataFrame, path_a: str, mark_a: str, path_b: str) -> DataFrame:
    """Counts, scores and the digest of the groups of every document.

    The groups are hashed in the pass that makes them; only the links are staged.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = align(documents, path_a, mark_a, path_b).withColumn("groups_sha256", digest).drop("groups")
    return pair_scores(stage(aligned, "aligned"), pair_size(path_a, path_b))
