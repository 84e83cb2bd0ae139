"""Repair of conversation structure: the cheapest edits that make a conversation start with an optional
system message and go on in pairs of user and assistant.

A conversation is a path through a small graph: between two rows stands one of four states (nothing yet,
after system, after user, after assistant), and each edit leads from state to state. An edit's weight is one
integer: its high digits are the cost, its low digits the letters of the audit, each in its own place, with zeros
behind the last one. The least integer is then the cheapest path with the least audit.
"""

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmon.session import broadcast_if_small, stage

INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
BLANKS = " \t\n\x0b\x0c\r"
MARKS = ".!?"
#: Rows that are decided together; the digits of one integer are three per row.
SEGMENT_ROWS = 256

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NOTHING, SYSTEM, USER, ASSISTANT)
#: State after a message of a role, by state before it; what is missing breaks the structure.
NEXT = {
    (NOTHING, "s"): SYSTEM,
    (NOTHING, "u"): USER,
    (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT,
    (ASSISTANT, "u"): USER,
}
INSERTED = {NOTHING: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
ROLES = {"u": "user", "a": "assistant"}
INITIALS = "sua"
OTHER, MUST_GO, CUT_SHORT = 3, 4, 8
#: Letters as octal digits; 0 is the padding behind an audit.
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTERS = str.maketrans({"0": None, "1": "D", "2": "I", "3": "K", "4": "R"})

SEGMENT_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns", "low_turn", "high_turn"]


def damage(conversations: DataFrame) -> DataFrame:
    """A fixed share of rows dropped, emptied, stripped of sentence ends, repeated or made the user's.

    What happens is decided by the checksum of ``conv_id:turn``. Null roles and texts become one space, and so
    do nulls in the checksum. A dropped row stays as a mark with ``dropped``, so that its conversation is known.
    """
    space = F.lit(" ")
    named = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(named.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    copies = F.when(kind == 3, F.array(F.lit(False), F.lit(False))).otherwise(F.array(kind == 0))
    return conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, MARKS, "")).otherwise(text).alias("text"),
        F.explode(copies).alias("dropped"),
    )


def _code(role: Column, text: Column) -> Column:
    """Number of the role's initial, with flags for texts that are blank or lack a sentence end."""
    trimmed = F.rtrim(text, F.lit(BLANKS))
    initial = F.substring(role, 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    last = F.substring(trimmed, -1, 1)
    return code + F.when(trimmed == "", MUST_GO).when(last.isin(*MARKS), 0).otherwise(CUT_SHORT)


def _prepared(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.when(~dropped, text).alias("text"),
        dropped.alias("dropped"),
    ).withColumns({"digest": F.unhex(F.md5(F.col("text").cast("binary"))), "code": _code(F.col("role"), F.col("text"))})


def _flagged(narrow: DataFrame) -> DataFrame:
    """Rows with ``later``: the same role and text come in an earlier turn of the conversation.

    Copies are combined per task before they are counted, and only texts of several turns are joined back.
    """
    same = ["conv_id", "role", "digest"]
    first = narrow.groupBy(*same).agg(
        F.max(F.col("turn").isNull()).alias("unnumbered"),
        F.min("turn").alias("first_turn"),
        F.max("turn").alias("last_turn"),
    )
    repeated = first.filter(
        "first_turn < last_turn OR (unnumbered AND first_turn IS NOT NULL)"
    ).select(*[F.col(c).alias(f"known_{c}") for c in same], "unnumbered", "first_turn")
    repeated = broadcast_if_small(stage(repeated, "repeated-messages"))
    joined = narrow.join(repeated, [F.col(c).eqNullSafe(F.col(f"known_{c}")) for c in same], "left")
    later = F.col("turn").isNotNull() & (F.col("unnumbered") | (F.col("turn") > F.col("first_turn")))
    return joined.select("conv_id", "turn", "role", "digest", "code", F.coalesce(later, F.lit(False)).alias("later"))


def _segments(id_type: pa.DataType):
    """Codes and counts of up to ``SEGMENT_ROWS`` consecutive rows of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        before = conv = None
        number, codes, counts = 0, bytearray(), dict.fromkeys(SEGMENT_COUNTS)

        def close(last: bool) -> None:
            out.append((conv, number, last, bytes(codes), *counts.values()))

        def batch_of() -> pa.RecordBatch:
            types = [id_type, pa.int32(), pa.bool_(), pa.binary(), *[pa.int64()] * len(SEGMENT_COUNTS)]
            names = ["conv_id", "segment", "last", "codes", *SEGMENT_COUNTS]
            columns = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "digest", "code", "later")]
            for found, turn, role, digest, code, later in zip(*columns, strict=True):
                fresh = before is None or found != conv
                if fresh or len(codes) == SEGMENT_ROWS:
                    if before is not None:
                        close(fresh)
                    number = 0 if fresh else number + 1
                    codes, counts = bytearray(), dict.fromkeys(SEGMENT_COUNTS, 0) | {"low_turn": None, "high_turn": None}
                    if len(out) >= 1000:
                        yield batch_of()
                conv = found
                initial = code & 3
                copy = not fresh and before[:3] == (turn, role, digest)
                if code & MUST_GO:
                    counts["blank"] += 1
                elif later or copy:
                    counts["duplicate"] += 1
                    code = initial | MUST_GO
                elif code & CUT_SHORT:
                    counts["truncated"] += 1
                if not fresh:
                    counts["illegal"] += (before[3], initial) not in ((0, 1), (1, 2), (2, 1))
                if turn is not None:
                    counts["turns"] += fresh or before[0] != turn
                    counts["low_turn"] = turn if counts["low_turn"] is None else counts["low_turn"]
                    counts["high_turn"] = turn
                codes.append(code)
                before = (turn, role, digest, initial)
        if before is not None:
            close(True)
            yield batch_of()

    return run


@cache
def edges(code: int, state: int) -> tuple[tuple[int, str, int], ...]:
    """Cheapest ``(cost, letters, next state)`` of a row in a state, insertions before it included.

    Two insertions lead back to a state of the same continuation at a higher cost, so more are never
    cheapest. Letters end with the one of the row: of two edges to one state the lesser one stays the lesser.
    """
    best: dict[int, tuple[int, str]] = {}
    cost, letters = 0, ""

    def offer(price: int, letter: str, after: int | None) -> None:
        if after is not None:
            best[after] = min(best.get(after, (1 << 30, "")), (cost + price, letters + letter))

    for _ in range(3):
        offer(DELETE, "D", state)
        if not code & MUST_GO:
            extra = TRUNCATED if code & CUT_SHORT else 0
            initial = code & 3
            offer(extra, "K", None if initial == OTHER else NEXT.get((state, INITIALS[initial])))
            for role in ROLES:
                offer(extra + REROLE, "R", NEXT.get((state, role)))
        state = NEXT[state, INSERTED[state]]
        cost, letters = cost + INSERT, letters + "I"
    return tuple((price, word, after) for after, (price, word) in sorted(best.items()))


def ending(state: int) -> tuple[int, str]:
    """Cost and letters of the insertions that complete a conversation."""
    letters = ""
    while state not in (NOTHING, ASSISTANT):
        state = NEXT[state, INSERTED[state]]
        letters += "I"
    return INSERT * len(letters), letters


ENDINGS = [ending(state) for state in STATES]


@cache
def _step(code: int, tail: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(min(cost + tail[after] for cost, _, after in edges(code, state)) for state in STATES)


def tail_costs(codes: bytes, tail: list[int]) -> list[int]:
    """Least cost from each state before the rows, given the least cost from each state behind them."""
    # The four costs differ little from one another, so few combinations occur.
    low = min(tail)
    relative = tuple(cost - low for cost in tail)
    for code in reversed(codes):
        stepped = _step(code, relative)
        least = min(stepped)
        low += least
        relative = tuple(cost - least for cost in stepped)
    return [low + cost for cost in relative]


def least_weights(codes: bytes, tail: list[int] | None) -> list[tuple[int, str]]:
    """Least cost and audit from each state before the rows, by dynamic programming over integers.

    ``tail`` has the costs behind the rows; without it the conversation ends there. Rows are taken from the
    last to the first: putting letters in front moves the low digits to the right, where padding gives way.
    """
    width = 3 * len(codes) + 2
    unit = 3 * width  # bits below the cost
    mask = (1 << unit) - 1

    def packed(letters: str) -> int:
        value = 0
        for place, letter in enumerate(letters):
            value |= DIGIT[letter] << (unit - 3 * (place + 1))
        return value

    if tail is None:
        values = [(cost << unit) + packed(letters) for cost, letters in ENDINGS]
    else:
        values = [cost << unit for cost in tail]
    known: dict[int, list[list[tuple[int, int, int]]]] = {}
    for code in reversed(codes):
        steps = known.get(code)
        if steps is None:
            steps = known[code] = [
                [((cost << unit) + packed(letters), 3 * len(letters), after) for cost, letters, after in edges(code, s)]
                for s in STATES
            ]
        low = [value & mask for value in values]
        high = [value - digits for value, digits in zip(values, low, strict=True)]
        values = [
            min(high[after] + weight + (low[after] >> moved) for weight, moved, after in found) for found in steps
        ]
    return [(value >> unit, f"{value & mask:0{width}o}".translate(LETTERS)) for value in values]


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tail: list[int] = []
    for batch in batches:
        found = []
        for last, codes in zip(batch.column("last").to_pylist(), batch.column("codes").to_pylist(), strict=True):
            if last:
                tail = [cost for cost, _ in ENDINGS]
            found.append(None if last else tail)
            tail = tail_costs(codes, tail)
        yield batch.append_column("tail", pa.array(found, pa.list_(pa.int64())))


def _drafts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("codes", "tail")]
        found = [least_weights(codes, tail) for codes, tail in zip(*columns, strict=True)]
        costs = pa.array([[cost for cost, _ in row] for row in found], pa.list_(pa.int64()))
        audits = pa.array([[audit for _, audit in row] for row in found], pa.list_(pa.string()))
        kept = batch.drop_columns(["codes", "tail", "last"])
        yield kept.append_column("costs", costs).append_column("audits", audits)


def drafts(rows: DataFrame) -> DataFrame:
    """Least costs and audits of every segment from each state before it, with the segment's counts.

    Only codes of rows are sorted into conversations, not their texts. Costs behind a segment come from one pass from
    the end of each conversation; the segments are then decided independently of one another.
    """
    id_type = rows.schema["conv_id"].dataType
    named = f"conv_id {id_type.simpleString()}, segment int"
    counts = ", ".join(f"{c} long" for c in SEGMENT_COUNTS)
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]
    narrow = stage(rows.filter("NOT dropped").select("conv_id", "turn", "role", "digest", "code"), "messages")
    ordered = _flagged(narrow).repartition("conv_id").sortWithinPartitions(*order)
    arrow_id = _arrow_type(id_type)
    whole = f"{named}, last boolean, codes binary, {counts}"
    segments = stage(ordered.mapInArrow(_segments(arrow_id), whole), "segments")
    backward = segments.repartition("conv_id").sortWithinPartitions("conv_id", F.col("segment").desc())
    tailed = backward.mapInArrow(_tails, f"{whole}, tail array<long>")
    dealt = tailed.repartition("conv_id", "segment")
    return dealt.mapInArrow(_drafts, f"{named}, {counts}, costs array<long>, audits array<string>")


def _arrow_type(id_type) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(id_type)


class Conversation:
    """One conversation in the order of its rows: takes the drafts, then the rows, and keeps no texts."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost = conv_id, NOTHING, 0
        self.drafts: list[list[str]] = []
        self.next_draft, self.letters, self.at = 0, "", 0
        self.taken: list[str] = []
        self.counts = dict.fromkeys(SEGMENT_COUNTS, 0) | {"low_turn": None, "high_turn": None}
        self.hash, self.size = hashlib.sha256(), 0

    def draft(self, costs: list[int], audits: list[str], counts: dict[str, int | None]) -> None:
        if not self.drafts:
            self.cost = costs[NOTHING]
        self.drafts.append(audits)
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            self.counts[name] += counts[name]
        if self.counts["low_turn"] is None:
            self.counts["low_turn"] = counts["low_turn"]
        if counts["high_turn"] is not None:
            self.counts["high_turn"] = counts["high_turn"]

    def _say(self, role: str, text: str) -> tuple[str, str]:
        self.hash.update(f"{chr(10) if self.size else ''}{role}:{text}".encode())
        self.size += 1
        return role, text

    def _insertions(self) -> Iterator[tuple[str, str, str]]:
        while self.letters[self.at : self.at + 1] == "I":
            self.at += 1
            role = INSERTED[self.state]
            self.state = NEXT[self.state, role]
            yield "I", *self._say(ROLES[role], "")

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired messages up to this row, each with its letter."""
        if self.at == len(self.letters):
            self.letters, self.at = self.drafts[self.next_draft][self.state], 0
            self.taken.append(self.letters)
            self.drafts[self.next_draft] = []
            self.next_draft += 1
        yield from self._insertions()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "R":
            role = ROLES[INSERTED[self.state]]
        if letter != "D":
            self.state = NEXT[self.state, role[:1]]
            yield letter, *self._say(role, text)

    def rest(self) -> Iterator[tuple[str, str, str]]:
        yield from self._insertions()

    def report(self) -> tuple:
        c = self.counts
        gaps = 0 if c["low_turn"] is None else c["high_turn"] - c["low_turn"] + 1 - c["turns"]
        faults = (c["blank"], c["duplicate"], c["truncated"], c["illegal"])
        return (self.conv_id, gaps, *faults, self.cost, "".join(self.taken), self.hash.hexdigest())


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
MESSAGE = "place long, edit string, role string, text string"


def _walk(id_type: pa.DataType, messages: bool):
    names = [part.split()[0] for part in (MESSAGE if messages else REPORT).split(", ")]
    types = {"place": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
    types |= {"audit": pa.string(), "repaired_sha256": pa.string()}

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [id_type, *[types.get(n, pa.int64()) for n in names]]
        columns = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["conv_id", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, out = None, []

        def said(found) -> None:
            for letter, role, text in found:
                if messages:
                    out.append((current.conv_id, current.size - 1, letter, role, text))

        def close() -> None:
            if current is not None:
                said(current.rest())
                if not messages:
                    out.append(current.report())

        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                if current is None or row["conv_id"] != current.conv_id:
                    close()
                    current = Conversation(row["conv_id"])
                if row["audits"] is not None:
                    current.draft(row["costs"], row["audits"], row)
                elif row["text"] is not None:
                    said(current.row(row["role"], row["text"]))
            if out:
                yield batch_of(out)
                out = []
        close()
        if out:
            yield batch_of(out)

    return run


def _repair(rows: DataFrame, messages: bool) -> DataFrame:
    prepared = _prepared(rows)
    columns = ["conv_id", "turn", "role", "digest", "text"]
    decided = drafts(prepared)
    both = prepared.select(*columns).unionByName(decided, allowMissingColumns=True)
    order = ["conv_id", F.col("audits").isNull(), "segment", F.col("turn").asc_nulls_first(), "role", "digest"]
    ordered = both.repartition("conv_id").sortWithinPartitions(*order).drop("digest", "turn")
    id_type = rows.schema["conv_id"].dataType
    schema = f"conv_id {id_type.simpleString()}, {MESSAGE if messages else REPORT}"
    return ordered.mapInArrow(_walk(_arrow_type(id_type), messages), schema)


def repaired_messages(rows: DataFrame) -> DataFrame:
    """The messages of every repaired conversation: ``conv_id, place, edit, role, text``.

    See :func:`repair_report` for the rules.
    """
    return _repair(rows, True)


def repair_report(rows: DataFrame) -> DataFrame:
    """Faults, cost, audit and digest of every conversation after its cheapest repair.

    Rows of a conversation are taken by ``turn``, nulls first, then by role and digest of the text. The first of
    these faults of a row counts: blank, duplicate (role and text came earlier), truncated (the last
    character that isn't white space is none of ``.!?``). Keeping a row costs 0, giving it the role of user or
    assistant 3, deleting it 4, inserting an empty message of user or assistant 3, and a truncated row that stays 3
    more; blank rows and duplicates have to go. What stays begins with at most one system message and goes on in
    pairs of user and assistant, told by the initials of their roles. ``audit`` has the letters of the
    edits in order: Keep, Rerole, Delete, Insert; of several cheapest repairs it is the least text.

    Null roles and texts count as one space. A row whose role is empty or begins with another letter cannot be kept.
    A null ``conv_id`` is a conversation of its own. Rows marked in an optional column ``dropped`` only tell
    that there is such a conversation. Equal rows are duplicates of one another. An empty table gives no
    rows; further columns are ignored.

    A digest over all texts of a conversation has to read them in order, so one task streams each
    conversation; it keeps the letters of that conversation, as its row does, and no text.
    """
    return _repair(rows, False)
