"""Conversation repair, mixing and alignment against brute force on small tables with awkward rows."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparkmon.llm import conversations
from sparkmon.llm.alignment import align, alignment_digests, common_ends, tokenizer_pair
from sparkmon.llm.conversations import damage, least_weights, repair_report, repaired_messages
from sparkmon.llm.mixing import mix, rating_weights
from sparkmon.llm.queries import ALIGNED_VOCABULARIES, ORACLES, QUERIES
from sparkmon.llm.tokens import ByteLevel, tokenizer_path
from tests.oracle_check import differences

STEPS = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
TALK = "conv_id long, turn long, role string, text string, audits string, code string"


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_mixing"])
def test_query_equals_sql(spark, folder, name):
    assert differences(QUERIES[name](spark, folder), folder, ORACLES[name]) == []


def cheapest(rows):
    """Faults, cost, audit and text by a search over all edits, cheapest and least audit first."""
    seen, faults = set(), []
    for role, text in rows:
        held = text.rstrip(" \t\n\x0b\x0c\r")
        known = (role, text) in seen
        faults.append("b" if not held else "d" if known else "" if held[-1] in ".!?" else "t")
        seen.add((role, text))
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, i, last, said = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return faults, cost, audit, "\n".join(said)
        new = [(c, name) for c, name in (("u", "user"), ("a", "assistant")) if (last, c) in STEPS]
        for c, name in new:
            if not audit.endswith("II"):
                heapq.heappush(heap, (cost + 3, audit + "I", i, c, (*said, f"{name}:")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, said))
            if faults[i] in ("", "t"):
                price = cost + 3 * (faults[i] == "t")
                if (last, role[:1]) in STEPS:
                    heapq.heappush(heap, (price, audit + "K", i + 1, role[:1], (*said, f"{role}:{text}")))
                for c, name in new:
                    heapq.heappush(heap, (price + 3, audit + "R", i + 1, c, (*said, f"{name}:{text}")))


def expected_report(rows, apply_damage):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20 if apply_damage else -1
        talk = talks[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        talk += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    found = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = {t for t, _, _ in talk if t is not None}
        faults, cost, audit, text = cheapest([r[1:] for r in talk])
        pairs = itertools.pairwise(r[1][:1] for r in talk)
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in pairs),
            cost,
            audit,
            hashlib.sha256(text.encode()).hexdigest(),
        )
    return found


@pytest.fixture(scope="module")
def talks():
    pick = random.Random(5)
    roles = ["system", "user", "assistant", "tool", None, "user", "assistant", "", "Ümlaut"]
    texts = ["Yes.", "no", "", " \t", None, "why?", "long " * 30_000, "a.\n\x0b", "b! ", "Yes."]
    rows = [
        (conv if conv else None, pick.choice([None, *range(4)]), pick.choice(roles), pick.choice(texts))
        for conv in range(60)
        for _ in range(pick.randrange(1, 7))
    ]
    return [*rows, (70, 3, "user", "Hi."), (70, 9, "assistant", "Ho."), *[(71, 1, "user", "Hi.")] * 3]


def talk_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", None) for r in rows], TALK).repartition(3)


@pytest.mark.parametrize("size, harmed", [(256, True), (256, False), (2, False)])
def test_repair_equals_a_search_over_all_edits(spark, talks, monkeypatch, size, harmed):
    monkeypatch.setattr(conversations, "SEGMENT_ROWS", size)
    frame = talk_frame(spark, talks)
    rows = repair_report(damage(frame) if harmed else frame).collect()
    got = {r.conv_id: tuple(r)[1:] for r in rows}
    assert len(rows) == len(got) and got == expected_report(talks, harmed)


def test_repaired_messages_are_those_of_the_digest(spark, talks):
    frame = talk_frame(spark, talks)
    said = defaultdict(dict)
    for r in repaired_messages(frame).collect():
        said[r.conv_id][r.place] = f"{r.role}:{r.text}"
    for conv, row in expected_report(talks, False).items():
        text = "\n".join(said[conv][i] for i in range(len(said[conv])))
        assert hashlib.sha256(text.encode()).hexdigest() == row[-1]


def test_a_conversation_without_rows_after_damage_is_reported(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"8:{t}".encode()) % 20 == 0)
    rows = repair_report(damage(talk_frame(spark, [(8, turn, "user", "Hi.")]))).collect()
    assert [tuple(r) for r in rows] == [(8, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repair_of_an_empty_table(spark):
    assert repair_report(damage(talk_frame(spark, []))).collect() == []


def test_long_conversations_are_decided_in_segments(spark):
    pick = random.Random(3)
    codes = bytes(pick.randrange(16) for _ in range(700))
    whole = least_weights(codes, None)
    head, tail = codes[:300], codes[300:]
    after = least_weights(tail, None)
    joined = least_weights(head, [cost for cost, _ in after])
    assert [cost for cost, _ in joined] == [cost for cost, _ in whole]
    assert all(w.startswith(j) for (_, w), (_, j) in zip(whole, joined))
    assert conversations.tail_costs(tail, [c for c, _ in conversations.ENDINGS]) == [c for c, _ in after]


DOCUMENTS = "doc_id long, text string, source string, size long, target string, links string"


def document_frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash", "clash") for r in rows], DOCUMENTS).repartition(3)


def expected_targets(sizes, weights=(5, 2, 1), repeats=3):
    """Share by weight, cap, and share the excess again until nothing is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ones, left = {}, set(order), float(sum(sizes.values()))
    while open_ones:
        level = left / sum(weight[s] for s in open_ones)
        capped = {s for s in open_ones if level * weight[s] > repeats * sizes[s]}
        for s in capped or open_ones:
            target[s] = float(repeats * sizes[s]) if capped else level * weight[s]
            left -= target[s] if capped else 0
        open_ones -= capped or open_ones
    return target


@pytest.fixture(scope="module")
def mixed_documents():
    pick = random.Random(2)
    sources = ["a", "b", "B", None, "é", "z", "tiny", "", "zz"]
    rows = [(i, "w " * pick.randrange(1, 40), pick.choice(sources)) for i in range(600)]
    rows += [(1000 + i, "w " * 20, "b") for i in range(400)]
    rows += [(None, "x y", "a"), (5, "again and again", "b"), (5, "again and again", "b"), (2000, None, "empty")]
    return [*rows, (2001, "", "empty"), (2002, " \t\n", None), (2003, "word " * 20_000, "z"), (2004, "one", "tiny")]


def test_mix_meets_its_targets(spark, mixed_documents):
    frame = document_frame(spark, mixed_documents)
    rows = mix(frame).collect()
    again = mix(frame.repartition(5)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(mixed_documents)
    sizes = defaultdict(int)
    for _, text, source in mixed_documents:
        sizes[source] += len((text or "").split())
    targets = expected_targets(sizes)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert r.taken in [k * r.size for k in range(4)]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    # Whole epochs come first: within a source no two documents differ by more than one epoch.
    for source in sizes:
        times = {r.taken // r.size for r in rows if r.source == source and r.size}
        assert not times or max(times) - min(times) <= 1


def test_quality_raises_the_share_of_a_document(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(4000)]
    frame = document_frame(spark, rows)
    labels = spark.createDataFrame(
        [(i, int(i % 4 < 2)) for i in range(3000)] + [(7, None), (None, 1), (2, 0), (2, 0)],
        "doc_id long, quality int",
    )
    taken = Counter()
    for r in mix(frame, rating_weights(labels), weights=(1, 3)).collect():
        if r.source == "a":
            taken[r.quality_weight] += r.taken / r.size
    # 2,000 of source a, 1,000 of them wanted: ratings 2.0 for ids 4k, 0.5 for ids 4k + 2 below 3,000.
    assert taken[2.0] / 750 > taken[1.0] / 500 > taken[0.5] / 750
    assert sum(taken.values()) == pytest.approx(1000, abs=1)


def test_mix_of_empty_tables_and_of_nothing_but_empty_texts(spark):
    assert mix(document_frame(spark, [])).collect() == []
    rows = mix(document_frame(spark, [(1, None, "a"), (2, "", None)])).collect()
    assert {(r.doc_id, r.size, r.target, r.taken) for r in rows} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


PATHS = (tokenizer_path(ALIGNED_VOCABULARIES[0]), ALIGNED_VOCABULARIES[1], tokenizer_path(ALIGNED_VOCABULARIES[2]))
TEXTS = [
    None, "", " ", "Hello world, hello.", "Hello world, hello.", "  two  spaces\n\n\ttabs", "a<|endoftext|>b <s> </s>",
    "▁ is an underline", "日本語😀 naïve Über-Straße 12345", "x" * 5000, "word " * 8000, "\x00\x01", "é" * 300, "<0x41>",
]


def expected_alignment(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=PATHS[2])
    pair = tokenizer_pair(*PATHS)
    found, counts = [], Counter()
    for text in texts:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        data = (" " + (text or "")).encode()
        sides = [[table[i] for i in ids] for table, ids in ((pair.bytes_a, a), (pair.bytes_b, b))]
        if not text or any(b"".join(side) != data for side in sides):
            found.append(([], [], [], []))
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, side))) for side in sides)
        shared, place_b = [], {end: j for j, end in enumerate(ends_b)}
        for i, end in enumerate(ends_a):
            if end in place_b:
                shared.append((i, place_b[end]))
        groups, last = [], (-1, -1)
        for i, j in shared:
            groups.append((a[last[0] + 1 : i + 1], b[last[1] + 1 : j + 1]))
            last = (i, j)
        links = [(a[i], b[j]) for i, j in shared]
        counts.update(links)
        found.append((a, b, groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for a, b, groups, links in found:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if a else ""
        n_best = sum(counts[link] == best[link[1]] for link in links)
        rows.append((len(a), len(b), len(groups), len(links), n_best, sum(map(counts.get, links)), digest))
    return rows


def test_alignment_equals_brute_force(spark):
    frame = document_frame(spark, [(i if i else None, text, "s") for i, text in enumerate(TEXTS)])
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    rows = {r.doc_id or 0: tuple(r[c] for c in columns) for r in alignment_digests(frame, *PATHS).collect()}
    assert [rows[i] for i in range(len(TEXTS))] == expected_alignment(TEXTS)
    assert sum(r[0] > 0 for r in rows.values()) >= 9


def test_alignment_of_tables_without_tokens(spark):
    assert alignment_digests(document_frame(spark, []), *PATHS).collect() == []
    row = alignment_digests(document_frame(spark, [(1, None, "s")]), *PATHS).collect()[0]
    assert (row.n_a, row.n_links, row.n_best, row.count_sum, row.groups_sha256) == (0, 0, 0, 0, "")


def test_aligned_groups_are_returned(spark):
    row = align(document_frame(spark, [(1, "Hello", "s")]), *PATHS).collect()[0]
    a, b = row.groups.split("|")
    assert row.n_groups == 1 and len(a.split(",")) == row.n_a and len(b.split(",")) == row.n_b


@pytest.mark.parametrize("seed", range(6))
def test_common_ends_whatever_the_stretches_between(seed):
    rng = np.random.default_rng(seed)
    size = 3000
    a = np.unique(rng.integers(1, size, size // (2 + seed)))
    b = np.unique(rng.integers(1, size, 20 if seed == 5 else size // 3))
    b = b[(b < 700) | (b > 700 + 300 * seed)]  # a long stretch without common ends
    a, b = (np.union1d(side, [size]) for side in (a, b))
    cut_a, cut_b = common_ends(a, b, np.array([len(a) - 1]), np.array([len(b) - 1]))
    assert a[cut_a].tolist() == b[cut_b].tolist() == np.intersect1d(a, b).tolist()


def test_ids_by_rank_are_those_of_the_tokenizer_file():
    from tokenizers import Tokenizer

    fast, whole = ByteLevel(PATHS[0]), Tokenizer.from_file(PATHS[0])
    texts = [t or "" for t in TEXTS] + [chr(c) + " a" + chr(c) * 2 + "1" for c in range(1, 0x3000)]
    for text, ids in zip(texts, fast.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
