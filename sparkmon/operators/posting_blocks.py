"""Steps of the inverted index on Arrow batches: counting, weighing and transposing many postings at a time.

Each takes the batches of one Spark partition and holds one batch and the end of the one before it.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Most tokens or postings in one row; a document or token of more has several rows.
PIECE = 65_536
#: From this number of documents on the postings of a token are dealt in slices of falling impact.
SLICED = 65_536


def _starts(*changes: np.ndarray) -> np.ndarray:
    """Where runs start, given where one row differs from the one before it."""
    return np.flatnonzero(np.concatenate([[True], np.logical_or.reduce(changes)]))


def _differs(column: pa.Array) -> np.ndarray:
    return pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)


def _plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _lists(starts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def count_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, token[], tf[]`` of rows ``doc, token[]`` in order of ``doc``.

    Rows that share an id are one document. The tokens of a document come in order, so copies are weighed alike.
    """
    docs = held_tokens = held_tf = None
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("token")
        column, tokens, lengths = batch.column("doc"), pc.list_flatten(lists), _lengths(lists)
        tf = np.ones(len(tokens), np.int64)
        if docs is not None:
            column, tokens = pa.concat_arrays([docs, column]), pa.concat_arrays([held_tokens, tokens])
            lengths, tf = np.append(len(held_tokens), lengths), np.append(held_tf, tf)
        run = np.append(0, np.cumsum(_differs(column)))
        first = _starts(run[1:] != run[:-1])
        at, place, vocabulary, tf = _counted(np.repeat(run, lengths), tokens, tf)
        end = np.searchsorted(at, run[-1])
        yield from _rows(column, first, at[:end], vocabulary.take(pa.array(place[:end])), tf[:end])
        docs, held_tokens, held_tf = column.slice(len(column) - 1), vocabulary.take(pa.array(place[end:])), tf[end:]
    if docs is not None:
        yield from _rows(docs, np.array([0]), np.zeros(len(held_tf), np.int64), held_tokens, held_tf)


def _counted(
    run: np.ndarray, tokens: pa.Array, tf: np.ndarray
) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Run, place in the sorted vocabulary, that vocabulary and count of each distinct token of a run, in order."""
    encoded = tokens.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary)
    vocabulary = encoded.dictionary.take(order)
    if not len(tokens):
        return run, run, vocabulary, tf
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    key = run * len(rank) + rank[encoded.indices.to_numpy()]
    by = np.argsort(key, kind="stable")
    key = key[by]
    starts = _starts(key[1:] != key[:-1])
    at, place = np.divmod(key[starts], len(rank))
    return at, place, vocabulary, np.add.reduceat(tf[by], starts)


def _pieces(run: np.ndarray) -> np.ndarray:
    """Where rows start if each holds a run, or ``PIECE`` of it."""
    begin = _starts(run[1:] != run[:-1])
    place = np.arange(len(run)) - np.repeat(begin, np.diff(np.append(begin, len(run))))
    return np.flatnonzero(place % PIECE == 0)


def _rows(
    docs: pa.Array, first: np.ndarray, run: np.ndarray, tokens: pa.Array, tf: np.ndarray
) -> Iterator[pa.RecordBatch]:
    if len(run):
        starts = _pieces(run)
        columns = [docs.take(pa.array(first[run[starts]])), _lists(starts, tokens), _lists(starts, pa.array(tf))]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "token", "tf"])


def count_documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``token, df`` of each batch of counts, to be added up."""
    for batch in batches:
        found = pc.value_counts(pc.list_flatten(batch.column("token")))
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["token", "df"])


class Frequent:
    """The frequent tokens with their idf and document frequencies, looked up in place."""

    def __init__(self, table: pa.Table):
        self.tokens = _plain(table.column("token"))
        # The last entry is for tokens that are not listed.
        self.idf = np.append(_plain(table.column("idf")).to_numpy(), 0.0)
        self.finer = np.append(_plain(table.column("df")).to_numpy() // SLICED, 0)

    def _weighed(self, batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lists = batch.column("token")
        tokens, lengths = pc.list_flatten(lists), _lengths(lists)
        at = pc.fill_null(pc.index_in(tokens, value_set=self.tokens), -1).to_numpy(zero_copy_only=False)
        tf = pc.list_flatten(batch.column("tf")).to_numpy(zero_copy_only=False)
        return tokens, np.repeat(np.arange(batch.num_rows), lengths), at, tf, tf * self.idf[at]

    def squares(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``doc, square`` of the frequent tokens of each row of counts, then ``doc, token, tf`` of the others."""
        names = ["doc", "token", "tf", "square"]
        for batch in batches:
            docs = batch.column("doc")
            tokens, row, at, tf, raw = self._weighed(batch)
            square = np.bincount(row, weights=raw * raw, minlength=batch.num_rows)
            n, rare = batch.num_rows, np.flatnonzero(at < 0)
            columns = [docs, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.array(square)]
            yield pa.RecordBatch.from_arrays(columns, names)
            columns = [docs.take(pa.array(row[rare])), tokens.take(pa.array(rare)), pa.array(tf[rare], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(rare), pa.float64())], names)

    def blocks(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``token, slice, impact[], doc[]`` of the frequent tokens in rows of counts with the norm of their document.

        Slices go by falling impact; the more documents have a token, the finer they are.
        """
        for batch in batches:
            _, row, at, _, raw = self._weighed(batch)
            listed = np.flatnonzero(at >= 0)
            if not len(listed):
                continue
            row, at, raw = row[listed], at[listed].astype(np.int64), raw[listed]
            impact = raw / batch.column("norm").to_numpy()[row]
            piece = np.maximum(np.floor(-np.log2(impact) * self.finer[at]), 0).astype(np.int64)
            span = piece.max() + 1
            key = at * span + piece
            by = np.argsort(key, kind="stable")
            key = key[by]
            starts = _starts(key[1:] != key[:-1])
            token, piece = np.divmod(key[starts], span)
            docs = batch.column("doc").take(pa.array(row[by]))
            columns = [self.tokens.take(pa.array(token)), pa.array(piece, pa.int64())]
            columns += [_lists(starts, pa.array(impact[by])), _lists(starts, docs)]
            yield pa.RecordBatch.from_arrays(columns, ["token", "slice", "impact", "doc"])


def merge_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``token, bound, best_doc, impact[], doc[]`` by falling impact, of blocks in order of token and slice."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        last = _groups(table)[-1]
        yield from _merged(table.slice(0, last))
        held = table.slice(last)
    if held is not None:
        yield from _merged(held)


def _groups(table: pa.Table) -> np.ndarray:
    return _starts(_differs(_plain(table.column("token"))), _differs(_plain(table.column("slice"))))


def _merged(table: pa.Table) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    groups = _groups(table)
    lists = _plain(table.column("impact"))
    run = np.repeat(np.repeat(np.arange(len(groups)), np.diff(np.append(groups, table.num_rows))), _lengths(lists))
    impact, doc = pc.list_flatten(lists), pc.list_flatten(_plain(table.column("doc")))
    falling = [("run", "ascending"), ("impact", "descending"), ("doc", "ascending")]
    by = pc.sort_indices(pa.RecordBatch.from_arrays([pa.array(run), impact, doc], ["run", "impact", "doc"]), falling)
    impact, doc, starts = impact.take(by), doc.take(by), _pieces(run)
    tokens = _plain(table.column("token")).take(pa.array(groups[run[starts]]))
    columns = [tokens, impact.take(pa.array(starts)), doc.take(pa.array(starts))]
    columns += [_lists(starts, impact), _lists(starts, doc)]
    yield pa.RecordBatch.from_arrays(columns, ["token", "bound", "best_doc", "impact", "doc"])
