"""FM-index over words: backward search on a wavelet matrix, for many patterns at once.

The index keeps the Burrows-Wheeler transform of a shard as one packed bit vector per bit of the word
numbers, with a count before every 64 bits. Patterns are at most ``DEPTH`` words long here, so suffixes
are sorted by that many words only: the bounds of a pattern's rows don't depend on the order of suffixes
that agree on more.
"""

import numpy as np

DEPTH = 64


class WaveletMatrix:
    """Rank of any symbol before any place, in as many steps as symbols have bits."""

    def __init__(self, symbols: np.ndarray, bound: int):
        self.bits = max(1, int(bound - 1).bit_length())
        self.levels = []
        self.bound = bound
        for bit in range(self.bits - 1, -1, -1):
            ones = (symbols >> bit) & 1
            packed = np.packbits(ones.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view(np.uint64)
            counts = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            zeros = len(symbols) - int(ones.sum())
            self.levels.append((bit, packed, counts.astype(np.int32), zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])
        every = np.arange(bound)
        self.starts = self._down(every, np.zeros(bound, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for bit, packed, counts, zeros in self.levels:
            word, inner = places >> 6, (places & 63).astype(np.uint64)
            below = packed[word] & ((np.uint64(1) << inner) - np.uint64(1))
            ones = counts[word] + np.bitwise_count(below)
            places = np.where((symbols >> bit) & 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self._down(symbols, places) - self.starts[symbols]


class FmIndex:
    """Index of several word sequences; matches never reach from one into the next."""

    def __init__(self, sequences: list[list[bytes]], threshold: int):
        if not 0 < threshold < DEPTH:
            raise ValueError("the threshold must lie below the sorting depth")
        self.threshold = threshold
        self.numbers: dict[bytes, int] = {}
        number = self.numbers.setdefault
        self.coded = [
            np.fromiter((number(w, len(self.numbers) + 1) for w in words), np.int64, len(words))
            for words in sequences
        ]
        self.lengths = np.array([len(words) for words in self.coded], np.int64)
        end = np.zeros(1, np.int64)  # 0 ends a sequence and is no word
        text = np.concatenate([part for words in self.coded for part in (words, end)] or [end])
        self.size = len(text)
        self._sort(text)
        bound = len(self.numbers) + 1
        self.transform = WaveletMatrix(text[self.suffixes - 1], bound)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=bound))))[:-1]
        owners = np.repeat(np.arange(len(self.coded)), self.lengths + 1)
        self.owner_of_row = owners[self.suffixes] if len(owners) else np.zeros(1, np.int64)
        self._blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _sort(self, text: np.ndarray) -> None:
        """Suffix order by doubling; keeps the ranks by 1, 2, 4 ... words."""
        rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
        self.ranks = [rank]
        span = 1
        while span < DEPTH:
            rank = self._joined(rank, rank, span)
            self.ranks.append(rank)
            span *= 2
        self.suffixes = np.argsort(rank, kind="stable")

    def _joined(self, rank: np.ndarray, behind: np.ndarray, span: int) -> np.ndarray:
        """Ranks by a prefix and what follows ``span`` words further on."""
        key = rank * (self.size + 1)
        key[: self.size - span] += behind[span:] + 1 if span < self.size else 0
        order = np.argsort(key, kind="stable")
        steps = np.concatenate(([0], np.diff(key[order]) != 0)).cumsum()
        joined = np.empty_like(rank)
        joined[order] = steps
        return joined

    def blocks(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The block of every row, and the first row of every block, of suffixes equal by ``depth`` words."""
        if depth not in self._blocks:
            level = depth.bit_length() - 1
            span = depth - (1 << level)
            rows = self.suffixes
            head = self.ranks[level][rows]
            behind = np.minimum(rows + span, self.size - 1)
            tail = np.where(rows + span < self.size, self.ranks[level][behind], -1)
            fresh = np.concatenate(([True], (np.diff(head) != 0) | (np.diff(tail) != 0)))
            self._blocks[depth] = (
                np.cumsum(fresh) - 1,
                np.append(np.flatnonzero(fresh), self.size),
            )
        return self._blocks[depth]

    def step(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Rows of the patterns with one more word in front."""
        first = self.first[symbols]
        bounds = self.transform.rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        return first + bounds[: len(low)], first + bounds[len(low) :]

    def code(self, sequences: list[list[bytes]]) -> list[np.ndarray]:
        number = self.numbers.get
        return [np.fromiter((number(w, 0) for w in s), np.int64, len(s)) for s in sequences]

    def matches(self, coded: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics up to the threshold for all positions of all sequences, end to end.

        Per position the number of words from there on that occur in the index, and a row of the index
        that starts with them. All sequences are read from the back at once.
        """
        lengths = np.array([len(c) for c in coded], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths)))
        flat = np.concatenate(coded) if coded else np.empty(0, np.int64)
        matched, row = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        lanes = np.argsort(-lengths, kind="stable")
        ends = starts[lanes + 1]
        low = np.zeros(len(lanes), np.int64)
        high = np.full(len(lanes), self.size, np.int64)
        length = np.zeros(len(lanes), np.int64)
        sorted_lengths = -lengths[lanes]
        block_of, block_first = self.blocks(self.threshold)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = int(np.searchsorted(sorted_lengths, -back, "right"))
            at = ends[:live] - back
            self._extend(flat[at], low, high, length, live)
            long_ = np.flatnonzero(length[:live] > self.threshold)
            if len(long_):
                block = block_of[low[long_]]
                low[long_], high[long_] = block_first[block], block_first[block + 1]
                length[long_] = self.threshold
            matched[at], row[at] = length[:live], low[:live]
        return matched, row

    def _extend(self, symbols, low, high, length, live: int) -> None:
        new_low, new_high = self.step(symbols, low[:live], high[:live])
        failed = np.flatnonzero((new_low >= new_high) | (symbols == 0))
        done = np.ones(live, bool)
        done[failed] = False
        low[:live][done], high[:live][done] = new_low[done], new_high[done]
        length[:live] += 1
        # Drop words from the end of the match until the word in front fits, or nothing is left.
        for lane in failed.tolist():
            low[lane], high[lane], length[lane] = self._shorter(
                int(symbols[lane]), int(low[lane]), int(length[lane]) - 1
            )

    def _shorter(self, symbol: int, row: int, length: int) -> tuple[int, int, int]:
        if symbol:
            one = np.array([symbol])
            for depth in range(length - 1, -1, -1):
                low, high = 0, self.size
                if depth:
                    block_of, block_first = self.blocks(depth)
                    low, high = block_first[block_of[row]], block_first[block_of[row] + 1]
                found = self.step(one, np.array([low]), np.array([high]))
                if found[0][0] < found[1][0]:
                    return int(found[0][0]), int(found[1][0]), depth + 1
        return 0, self.size, 0

    def smallest_owner(self, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The smallest value of a sequence that holds the threshold's words of each row."""
        block_of, block_first = self.blocks(self.threshold)
        smallest = np.minimum.reduceat(values[self.owner_of_row], block_first[:-1])
        return smallest[block_of[rows]]
