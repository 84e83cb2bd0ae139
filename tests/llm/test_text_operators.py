"""The corpus operators against brute force on small tables with awkward rows."""

import hashlib

import duckdb
import numpy as np
import pytest

from sparkmon.llm import decontaminate, fingerprints, licenses, near_duplicates, queries, substring_dedup

WORDS = [f"w{i}" for i in range(400)]
DOCUMENTS = "doc_id long, text string, n_words string, spans string, label string"


def passage(seed: int, size: int) -> list[str]:
    return np.random.default_rng(seed).choice(WORDS, size).tolist()


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, repeats within a text, empty, null and long ones."""
    base, other, shared = passage(1, 300), passage(2, 220), passage(3, 70)
    rows = {
        1: base,
        2: base,
        3: [*base[:100], "changed", *base[101:]],
        4: [*passage(4, 60), *shared, *passage(5, 40)],
        5: [*passage(6, 10), *shared, *passage(7, 90)],
        6: other,
        7: [*other[:215], "tail"],
        8: shared[:50],
        9: shared[:49],
        10: ["again"] * 130,
        11: ["again"] * 70,
        12: ["one"],
        13: ["one"],
        14: [],
        15: [],
        17: passage(8, 4000) + shared + passage(8, 4000),
        18: ["A", "b", "C", "d"],
        19: ["a", "B", "c", "D"],
    }
    found = [(doc, "\t".join(words[:5]) + "\n" + "  ".join(words[5:])) for doc, words in rows.items()]
    return [*found, (16, None), (None, " ".join(base)), (20, "x y z  été ")]


def frame(spark, rows, parts=3):
    extra = [(*row, "clash", "clash", None) for row in rows]
    return spark.createDataFrame(extra, DOCUMENTS).repartition(parts)


def words_of(text, lower=False):
    data = (text or "").encode()
    return (data.translate(bytes.maketrans(*[bytes(r) for r in (range(65, 91), range(97, 123))])) if lower else data).split()


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def expected_removals(rows):
    first = {}
    for doc, text in rows:
        if doc is not None:
            words = words_of(text)
            for i in range(len(words) - 49):
                window = tuple(words[i : i + 50])
                first[window] = min(first.get(window, doc), doc)
    for doc, text in rows:
        words = words_of(text)
        gone = set()
        for i in range(len(words) - 49) if doc is not None else ():
            if first[tuple(words[i : i + 50])] < doc:
                gone.update(range(i, i + 50))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        yield doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()


COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("crowded, shard", [(8_000, 300_000), (0, 300_000), (8_000, 1)])
def test_substring_dedup(spark, texts, monkeypatch, crowded, shard):
    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard)
    got = rows_of(substring_dedup.without_repeats(frame(spark, texts)), *COLUMNS)
    assert got == sorted(expected_removals(texts), key=str)


def test_substring_dedup_of_rows_that_share_an_id(spark):
    a, b = " ".join(passage(1, 80)), " ".join(passage(2, 80))
    rows = [(1, a), (2, a), (2, b), (2, b), (3, b)]
    got = rows_of(substring_dedup.without_repeats(frame(spark, rows)), "doc_id", "n_removed")
    assert got == [(1, 0), (2, 0), (2, 0), (2, 80), (3, 80)]


def test_cleaned_documents_keep_columns_and_untouched_texts(spark):
    a = " ".join(passage(1, 80))
    rows = [(1, a + "\n x"), (2, "new  words " + a), (3, a), (4, None), (5, "")]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 1.5) for r in rows], "doc_id long, text string, n_chars long, spans double")
    got = rows_of(substring_dedup.cleaned_documents(docs), *docs.columns)
    assert got == sorted([(1, a + "\n x", len(a) + 3, 1.5), (2, "new words", 9, 1.5), (4, None, 0, 1.5), (5, "", 0, 1.5)], key=str)


def expected_contamination(rows, items):
    def words(text):
        data = bytearray((text or "").encode())
        for i, b in enumerate(data):
            if 65 <= b <= 90:
                data[i] = b + 32
            elif b < 128 and not (48 <= b <= 57 or 97 <= b <= 122):
                data[i] = 32
        return bytes(data).split()

    windows = {}
    for item, text in items:
        w = words(text)
        size = min(13, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(None if item is None else str(item))
    sizes = {len(w) for w in windows}
    for doc, text in rows:
        w = words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                held = windows.get(tuple(w[i : i + size]))
                if held:
                    hit.update(range(i, i + size))
                    found |= held
        found.discard(None)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_bytes", [8 << 20, 200])
def test_decontamination(spark, texts, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    by_id = dict(texts)
    items = [
        (10, by_id[1][300:700].upper()),
        (9, by_id[4]),
        (8, "one"),
        (7, "again again"),
        (6, None),
        (5, " ,;"),
        (4, "été"),
        (3, by_id[4]),
        (None, by_id[1][100:250]),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(frame(spark, texts), benchmark)
    assert rows_of(found, *found.columns) == sorted(expected_contamination(texts, items), key=str)


def test_decontamination_of_items_without_id_equals_its_sql(spark, texts, tmp_path):
    by_id = dict(texts)
    items = [(2, by_id[4]), (None, by_id[1][100:400]), (None, "one"), (1, by_id[1][:200]), (None, None)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE TEMP VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = queries.op4_decontaminate(spark, str(tmp_path))
    expected = sorted(duckdb.sql(queries.DECONTAMINATE_SQL).fetchall(), key=str)
    assert rows_of(found, *found.columns) == expected
    assert any(r[2] and not r[3] for r in expected)  # hit by an item without an id alone


def expected_groups(rows):
    sets = {}
    for doc, text in rows:
        words = words_of(text, lower=True)
        if doc is not None and words:
            grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}
            sets[doc] = grams
    label = {doc: doc for doc in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    for doc, text in rows:
        group = root(doc) if doc in sets else doc
        words = words_of(text, lower=True)
        size = len({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else ()))
        yield doc, size, group, doc is None or doc == group


GROUPS = ("doc_id", "n_shingles", "component_id", "kept")


def test_near_duplicates(spark, texts):
    got = rows_of(near_duplicates.near_duplicate_groups(frame(spark, texts)), *GROUPS)
    assert got == sorted(expected_groups(texts), key=str)


@pytest.mark.parametrize("leads", [0, near_duplicates.LEADS])
def test_near_duplicates_beyond_the_hub(spark, monkeypatch, leads):
    """Chains of small edits: most links are between texts that are no longer like the first one."""
    monkeypatch.setattr(near_duplicates, "LEADS", leads)
    rng = np.random.default_rng(5)
    rows, words = [], passage(9, 150)
    for doc in range(120):
        if doc % 4 == 0 and doc:
            words = rows[rng.integers(len(rows))][1].split()
        words = list(words)
        for _ in range(int(rng.integers(1, 4))):
            words[int(rng.integers(len(words)))] = f"e{doc}-{rng.integers(99)}"
        rows.append((doc + 1, " ".join(words)))
    got = rows_of(near_duplicates.near_duplicate_groups(frame(spark, rows)), *GROUPS)
    expected = sorted(expected_groups(rows), key=str)
    assert got == expected and len({row[2] for row in expected}) > 1


def test_min_max_signatures_estimate_likeness():
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 2**63, 1500).astype(np.uint64))
    a, b = values[:1100], values[300:1400]
    rows = near_duplicates.signatures([a, b])
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((rows[0] == rows[1]).mean() - true) < 0.15


def test_fingerprints(spark, texts):
    rows = [(doc, text) for doc, text in texts if doc is not None]
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(frame(spark, rows)).collect()}
    ordered = sorted((doc, text or "") for doc, text in rows)
    assert len(got) == len(ordered)
    for (doc, text), (_, following) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
        cut = len(text) // 2
        edited = text[: len(text) - cut] + following[:cut]
        row = got[doc]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        sketches = []
        for whole in (text, edited, following):
            phrases, phrase = set(), b""
            for byte in whole.encode():
                phrase += bytes([byte])
                if phrase not in phrases:
                    phrases.add(phrase)
                    phrase = b""
            sketches.append(fingerprints.smallest(phrases | ({phrase} if phrase else set())))
        assert row["fingerprint"] == fingerprints.text_of(sketches[0])
        assert row["edited_fingerprint"] == fingerprints.text_of(sketches[1])
        assert row["near_edited"] == fingerprints.likeness(sketches[0], sketches[1])
        assert row["near_next"] == fingerprints.likeness(sketches[0], sketches[2])
    assert got[1]["fingerprint"] == got[2]["fingerprint"] and got[1]["near_next"] == 1.0


def test_fingerprints_of_one_of_none_and_of_null_ids(spark):
    one = fingerprints.fingerprints(frame(spark, [(5, "abcabc")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and one["near_next"] == 1.0
    assert fingerprints.fingerprints(frame(spark, []).filter("false")).count() == 0
    nulls = fingerprints.fingerprints(frame(spark, [(None, "b"), (None, "a"), (1, "cd"), (1, "ef")])).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in nulls) == [("1", 2), ("1", 2), ("None", 1), ("None", 1)]
    # The last row's next one is the first of all.
    last = hashlib.sha256(b"ea").hexdigest()
    assert [r["edited_sha256"] for r in nulls if r["edited_sha256"] == last] == [last]


def test_patience_alignment():
    template = "a b c d e f g h".split()
    for text, aligned in (
        ("a b c d e f g h", 8),
        ("x a b c y d e f g h z", 8),
        ("a b q d e f h", 6),
        ("h g f e d c b a", 1),
        ("", 0),
        ("a a a b b", 1),
    ):
        pairs = licenses.align(text.split(), template)
        assert len(pairs) == aligned, text
        assert all(text.split()[i] == template[j] for i, j in pairs)
        assert pairs == sorted(pairs) and len({j for _, j in pairs}) == len(pairs)


def test_longest_increasing_matches_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(50):
        values = rng.permutation(9).tolist()
        best = max(
            sum(1 for i in range(9) if mask >> i & 1)
            for mask in range(512)
            if (lambda c: c == sorted(c))([v for i, v in enumerate(values) if mask >> i & 1])
        )
        chain = [values[i] for i in licenses.longest_increasing(values)]
        assert chain == sorted(chain) and len(chain) == best


def test_license_is_found_if_the_words_it_lacks_stand_elsewhere():
    """Fifty notices without four words, each of which occurs once in another place."""
    lacking = ["portions", "substantial", "furnished", "sublicense"]
    known = licenses.Templates({"MIT": licenses.TEMPLATES["MIT"]})
    notice = [w for w in licenses.TEMPLATES["MIT"].encode().translate(licenses.ALNUM).split() if w.decode() not in lacking]
    words = [w for word in lacking for w in (*[b"x"] * 300, word.encode())] + ([b"x"] * 300 + notice) * 50
    coded = np.array([known.numbers.get(w, 0) for w in words])
    assert [(n, aligned) for n, aligned, _, _ in known.scan(coded, 0.8)] == [(0, len(notice))]


def test_licenses_that_differ_in_a_word_are_told_apart(spark):
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    cases = {
        "Released under the BSD License.": ["BSD notice"],
        "Released under the Foo License.": [],
        "Licensed under CC BY-SA 4.0.": ["CC-BY-SA-4.0 notice"],
        gnu.format("Lesser ", 3): ["LGPL-3.0 notice"],
        gnu.format("Affero ", 3): ["AGPL-3.0 notice"],
        gnu.format("", 2): ["GPL-2.0 notice"],
        gnu.format("", 3): ["GPL-3.0 notice"],
        "Licensed under the Apache License, Version 1.1.": [],
        "Licensed under CC BY-NC 4.0. Text between. Licensed under CC BY 4.0. Released under the MIT License.":
            ["CC-BY-NC-4.0 notice", "MIT notice", "CC-BY-4.0 short notice"],
    }
    got = {r["doc_id"]: r for r in licenses.license_scan(frame(spark, list(enumerate(cases)))).collect()}
    for doc, names in enumerate(cases.values()):
        assert sorted(one["license"] for one in got[doc]["licenses"]) == sorted(names)
        assert got[doc]["n_licenses"] == len(names)
    assert {(one["start"], one["end"]) for one in got[8]["licenses"]} == {(0, 7), (9, 15), (15, 20)}


def test_license_scan(spark):
    mit = licenses.TEMPLATES["MIT"]
    noise = " ".join(passage(3, 500))
    rows = [
        (1, f"{noise}\nReleased under the MIT License.\n{noise}"),
        (2, f"{noise} {mit.upper()} {noise}"),
        (3, f"{noise} {mit.replace('without restriction', 'freely')} {noise}"),
        (4, noise),
        (5, None),
        (6, ""),
        (7, "license " * 3000),
        (8, "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0."),
        (9, "released under the license"),
    ]
    got = {r["doc_id"]: r for r in licenses.license_scan(frame(spark, rows)).collect()}
    assert got[1]["license"] == "MIT notice" and got[1]["coverage"] == 1.0 and got[1]["start"] == 500
    assert got[2]["license"] == "MIT" and got[2]["coverage"] == 1.0
    assert got[3]["license"] == "MIT" and 0.95 < got[3]["coverage"] < 1.0
    assert got[8]["license"] == "CC-BY-NC-4.0 notice"
    assert all(got[d]["license"] is None and got[d]["coverage"] == 0.0 for d in (4, 5, 6, 7))
    assert got[9]["license"] == "MIT notice" and got[9]["coverage"] == 0.8


def test_empty_tables(spark):
    empty = frame(spark, []).filter("false")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for result in (
        substring_dedup.without_repeats(empty),
        near_duplicates.near_duplicate_groups(empty),
        decontaminate.contamination(empty, benchmark),
        licenses.license_scan(empty),
    ):
        assert result.count() == 0


def test_crossing_pairs_stay_far_below_all_pairs(spark):
    """A third of all rows are variants of one text, most of them unlike each other."""
    rng = np.random.default_rng(8)
    base = passage(11, 150)
    rows = [(0, " ".join(base))]
    for doc in range(1, 400):
        words = list(base)
        for place in rng.choice(150, int(rng.integers(1, 7)), False):
            words[place] = f"e{doc}-{place}"
        rows.append((doc, " ".join(words)))
    got = rows_of(near_duplicates.near_duplicate_groups(frame(spark, rows)), *GROUPS)
    assert got == sorted(expected_groups(rows), key=str)
