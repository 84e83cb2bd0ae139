"""Token files, packing, page texts, classifiers and the pipeline on small tables."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sparkmon.llm import html_text, learning, packing, quality, queries, token_files, toxicity
from sparkmon.llm.fm_index import FmIndex
from sparkmon.llm.tokens import encoder, tokenizer_path

ODD = [
    "",
    " ",
    "  a  b\n\n c\t",
    "x<|endoftext|> y <|startoftext|>z",
    "don't we're it's, O'CLOCK...",
    "café café 你好 world。 x",
    "A.B,C|| D!? e;",
    "12 3,4 5.6",
    "a\x1fb \x1c c\x85d e  f",
    "ΣΣ İstanbul. STRASSE",
    "word, word. Word WORD word",
    "a'sb'Rec'ed\"'s '' __x_1_ 2×3÷4 ªº ²¼ ǅŒı",
    "\t\r\x0b\x0cend\x7f \x00",
]


@pytest.mark.parametrize(
    "vocabulary", [queries.FILE_VOCABULARY, queries.PACK_VOCABULARY], ids=["word", "byte"]
)
def test_ids_by_rank_are_those_of_the_tokenizer(spark, folder, vocabulary):
    name, mark, spaced, _ = vocabulary
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()] + ODD
    whole = Tokenizer.from_file(tokenizer_path(name)).encode_batch(texts, add_special_tokens=False)
    found = encoder(tokenizer_path(name), mark, spaced).encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [encoding.ids for encoding in whole]


def test_every_entry_of_the_word_vocabulary_is_its_own_text():
    name, mark, spaced, _ = queries.FILE_VOCABULARY
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    texts = [token.removesuffix("</w>") for token in tokenizer.get_vocab()]
    whole = tokenizer.encode_batch(texts, add_special_tokens=False)
    found = encoder(tokenizer_path(name), mark, spaced).encode(texts)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [encoding.ids for encoding in whole]


@pytest.mark.parametrize("size", [0, 1, 511, 512, 513, 5000])
def test_codes_give_random_access(size):
    rng = np.random.default_rng(size)
    ids = rng.choice([0, 3, 255, 256, 49_000, 70_000, 2**24 + 5, 2**32 - 1], size).astype(np.uint32)
    codes = token_files.Codes(token_files.pack(ids))
    assert len(codes) == size and codes.all().tolist() == ids.tolist()
    for place in rng.integers(0, size, 200) if size else ():
        assert codes[int(place)] == ids[place]
    with pytest.raises(IndexError):
        codes[size]


def whole_ids(vocabulary, text):
    tokenizer = Tokenizer.from_file(tokenizer_path(vocabulary[0]))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, vocabulary[3]]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ROWS = [(7, "b word"), (3, None), (5, "x" * 4000), (None, "first"), (3, "again"), (9, ""), (8, "a b " * 3000)]


def test_token_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 50)
    docs = spark.createDataFrame([(*r, "clash") for r in ROWS], "doc_id long, text string, start string")
    name, mark, spaced, end_id = queries.FILE_VOCABULARY
    path = queries.fresh_dir(spark, "test-ids")
    token_files.write_ids(docs.repartition(3), path, tokenizer_path(name), mark, spaced, end_id)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_documents(spark, path).collect())
    expected, start = [], 0
    for doc, text in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole_ids(queries.FILE_VOCABULARY, text)
        expected.append((start, doc, len(ids), crc(ids)))
        start += len(ids)
    assert got == expected


def test_token_files_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = queries.fresh_dir(spark, "test-ids")
    name, mark, spaced, end_id = queries.FILE_VOCABULARY
    token_files.write_ids(docs, path, tokenizer_path(name), mark, spaced, end_id)
    assert token_files.read_documents(spark, path).count() == 0


def check_packing(rows, docs, capacity=2048):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    for doc, text in docs:
        ids = whole_ids(queries.PACK_VOCABULARY, text)
        pieces = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert len(pieces) == max(1, -(-len(ids) // capacity))
        at = 0
        for number, piece in enumerate(pieces):
            assert (piece["piece"], piece["start"]) == (number, at)
            assert piece["ids_crc32"] == crc(ids[at : at + piece["length"]])
            assert number == 0 or piece["length"] == capacity
            at += piece["length"]
        assert at == len(ids)
    total = sum(r["length"] for r in rows)
    return len(by_sequence), -(-total // capacity)


def test_packing_keeps_every_id_and_wastes_little(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = queries.op6_packing(spark, folder).collect()
    used, least = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert used <= least + max(2, 0.01 * least)


def test_packing_of_awkward_rows(spark):
    docs = [r for r in ROWS if r != (3, "again")]
    name, mark, spaced, end_id = queries.PACK_VOCABULARY
    df = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, length string")
    rows = packing.pack_documents(df.repartition(4), tokenizer_path(name), mark, spaced, end_id).collect()
    check_packing(rows, docs)
    empty = packing.pack_documents(df.filter("false"), tokenizer_path(name), mark, spaced, end_id)
    assert empty.count() == 0


def fewest_sequences(lengths, capacity):
    """The least number of sequences by search over all ways to place the lengths, longest first."""
    best = len(lengths)

    def place(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for i in {room: i for i, room in enumerate(rooms) if room >= lengths[at]}.values():
            place(at + 1, [*rooms[:i], rooms[i] - lengths[at], *rooms[i + 1 :]])
        place(at + 1, [*rooms, capacity - lengths[at]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(6))
def test_plan_of_few_lengths_needs_hardly_more_than_the_least(seed):
    rng = np.random.default_rng(seed)
    lengths = sorted((int(n) for n in rng.integers(100, 1400, 11)), reverse=True)
    rows = packing.plan(np.bincount(lengths, minlength=2049))
    assert sum(r for r, _ in rows) <= fewest_sequences(lengths, 2048) + 1


@pytest.mark.parametrize("seed", range(4))
def test_plan_keeps_the_best_share(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, rng.lognormal(6.5, 1.0, 5_000).astype(int) + 1)
    histogram = np.bincount(lengths, minlength=2049)
    shares = packing.PATTERN_SHARES

    def sequences(tried):
        monkeypatch.setattr(packing, "PATTERN_SHARES", tried)
        return sum(r for r, _ in packing.plan(histogram))

    assert sequences(shares) == min(sequences((share,)) for share in shares)


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_up_the_histogram(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, rng.lognormal(6, 1.2, 20_000).astype(int) + 1)
    histogram = np.bincount(lengths, minlength=2049)
    rows = packing.plan(histogram)
    used = np.zeros(2049, int)
    for repeats, chosen in rows:
        assert repeats > 0 and sum(chosen) <= 2048
        for n in chosen:
            used[n] += repeats
    assert (used == histogram).all() and len(rows) < 4 * 2048
    assert sum(r for r, _ in rows) <= 1.005 * -(-lengths.sum() // 2048) + 1


def test_nnls_meets_its_conditions():
    rng = np.random.default_rng(0)
    matrix, target = rng.random((20, 60)), rng.random(20) * 100
    solution = packing.nnls(matrix, target)
    gradient = matrix.T @ (target - matrix @ solution)
    assert (solution >= 0).all() and (gradient < 1e-5).all()
    assert np.abs(gradient[solution > 0]).max(initial=0) < 1e-5


@pytest.mark.parametrize("threshold", [1, 2, 5])
def test_matching_statistics(threshold):
    rng = np.random.default_rng(threshold)
    words = [b"a", b"b", b"c", b"d"]
    known = [rng.choice(words, int(n)).tolist() for n in rng.integers(1, 60, 12)]
    asked = [rng.choice([*words, b"new"], int(n)).tolist() for n in rng.integers(0, 50, 15)]
    index = FmIndex(known, threshold)
    parts = {tuple(k[i : i + n]) for k in known for n in range(1, threshold + 1) for i in range(len(k) - n + 1)}
    matched, rows = index.matches(index.code(asked))
    at = 0
    values = np.arange(100, 100 + len(known))
    owners = index.smallest_owner(values, rows)
    for words_of in asked:
        for i in range(len(words_of)):
            longest = max((n for n in range(1, threshold + 1) if tuple(words_of[i : i + n]) in parts and i + n <= len(words_of)), default=0)
            assert matched[at] == longest
            if longest == threshold:
                part = words_of[i : i + threshold]
                holders = [100 + k for k, seq in enumerate(known) if any(seq[j : j + threshold] == part for j in range(len(seq)))]
                assert owners[at] == min(holders)
            at += 1


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site name</h1><p>Our claim, and more.</p></header>
<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, as many as we can, to please you, and others.</p></div>
<div id="page"><div class="content"><h2>A  heading &amp; more</h2>
<p>First paragraph, with <b>bold</b> and <a href=x>a link</a>, and enough text to be scored well by length.
<p>Second&nbsp;one,<br>broken in a line, with 1 &lt; 2 and so on, long enough, again, to count for something.</p>
<div class="ad"><p>Buy this now, it is cheap, it is good, it is what you want, really.</p></div>
<form><p>Your mail, please, and your name, and your street.</p><input name=q></form>
<ul><li>point one</li><li>point two</ul></div>
<aside><p>Something else, which is not the article, but long, and with commas, too.</p></aside></div>
<div id="comments"><p>Great article, thanks a lot, I learned much, and will be back, surely.</p></div>
<footer><p>&copy; all rights, reserved</p></footer></body>"""

TEXT = """A heading & more
First paragraph, with bold and a link, and enough text to be scored well by length.
Second one, broken in a line, with 1 < 2 and so on, long enough, again, to count for something.
point one
point two"""


def test_page_text():
    assert html_text.main_text(PAGE) == TEXT


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain words, no tags", "plain words, no tags"),
        ("<p>one<p>two", "one\ntwo"),
        ("<nav><a href=/>x</a></nav>", ""),
        ("<article><h1>Only a title</h1><p><b>Only a title<br></article><footer>f</footer>", "Only a title\nOnly a title"),
        ('<p title="a > b">in</p><a href="unclosed>', "in"),
        ("<script>never closed <p>x", ""),
        ("<p>a <!-- hidden > text --> b</p><!-- open", "a b"),
        ("<div hidden><p>no</p></div><div><p>yes, this one</p></div>", "yes, this one"),
        ("5 < 6 and <3", "5 < 6 and <3"),
    ],
)
def test_page_text_of_small_and_broken_pages(html, text):
    assert html_text.main_text(html) == text


def test_page_text_is_linear_on_hostile_pages():
    for html in ("<" * 200_000, "<a " * 60_000, "<div>" * 30_000, '<p x="' * 40_000, "<p>" * 50_000 + "end"):
        html_text.main_text(html)


def test_page_texts_of_a_table(spark):
    rows = [(1, "u", PAGE, "c"), (None, None, None, "c"), (1, "u", PAGE, "c"), (2, "v", "", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in html_text.page_texts(pages).collect())
    assert got == [("1", TEXT, len(TEXT))] * 2 + [("2", "", 0), ("None", "", 0)]
    assert html_text.page_texts(pages.filter("false")).count() == 0


LONG = "The harbour was quiet that morning, and nobody on the pier, as far as we know, saw the boat leave."


@pytest.mark.parametrize(
    "start, end",
    [
        ('<div class="overflow-hidden">', "</div>"),
        ('<div class="site no-sidebar">', "</div>"),
        ('<div id="layout-no-sidebars">', "</div>"),
        ('<section class="has-sidebar">', "</section>"),
        ('<article title="hidden treasures">', "</article>"),
        ('<div data-hidden="false" data-role="menu">', "</div>"),
        ("<div title='x class=\"menu\" style=\"display:none\"'>", "</div>"),
        ('<div class="promo banner">', "</div>"),
        ('<div id="widget"><div class="comments">', "</div></div>"),
    ],
)
def test_names_around_the_article_do_not_lose_it(start, end):
    page = f'<body><div class="menu"><a>Home</a></div>{start}<p>{LONG}</p><p>{LONG}</p>{end}<div>end</div></body>'
    assert html_text.main_text(page) == f"{LONG}\n{LONG}"


LINKS = "<ul><li><a href=/1>One source</a></li><li><a href=/2>Another source</a></li></ul>"
LISTED = "One source\nAnother source"


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<nav>{LINKS}</nav><article><p>{LONG}</p>{LINKS}</article>", f"{LONG}\n{LISTED}"),
        (f"<body>{LINKS}<div><p>{LONG}</p><p>{LONG}</p>{LINKS}</div>{LINKS}</body>", f"{LONG}\n{LONG}\n{LISTED}"),
        (f"<body><div><p>Ja, <a>{LONG}</a></p><p>So, <a>{LONG}</a></p></div></body>", f"Ja, {LONG}\nSo, {LONG}"),
        (f"<body>{LINKS}<p>{LONG}</p>{LINKS}<p>{LONG}</p>{LINKS}</body>", f"{LONG}\n{LISTED}\n{LONG}"),
        (f"<body>{LINKS}<p>{LONG}</p><h2>Sources</h2>{LINKS}</body>", f"{LONG}\nSources\n{LISTED}"),
        (f"<body>{LINKS}</body>", ""),
        (
            f"<body><div>{f'<p>{LONG}</p>' * 9}</div><div><p>It ended there.</p></div>{LINKS}</body>",
            "\n".join([LONG] * 9 + ["It ended there."]),
        ),
    ],
)
def test_link_lists_and_short_parts_of_the_article_stay(html, text):
    assert html_text.main_text(html) == text


def test_comments_hidden_parts_and_menus_are_no_article():
    talk = "".join(f"<li>{LONG} {LONG}</li>" for _ in range(20))
    for attributes in ('class="comments"', "hidden", 'style="display: none"', 'class="cookie-consent"'):
        page = f"<body><div><p>{LONG}</p><p>{LONG}</p></div><div {attributes}><ul>{talk}</ul></div></body>"
        assert html_text.main_text(page) == f"{LONG}\n{LONG}"
    assert html_text.main_text('<div class="menu"><ul><li>Home<li>News<li>About</ul></div>') == ""


def test_toxicity_on_the_held_out_fold(spark, folder):
    folder = folder.replace("sf0.001", "sf0.01")
    scores = queries.op7_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = scores.join(labels, "doc_id").filter("held_out")
    row = held.agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("right"),
        F.avg(F.when(F.col("toxic") == 0, F.col("predicted"))).alias("false_alarms"),
    ).first()
    assert row.right > 0.9 and row.false_alarms < 0.05
    assert scores.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    wrong = scores.filter((F.col("score") < 0) | (F.col("score") > 1) | ((F.col("score") >= 0.5) != (F.col("predicted") == 1)))
    assert wrong.count() == 0
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    assert scores.filter(F.col("held_out") != remainder).count() == 0


def test_quality_on_the_held_out_fold(spark, folder):
    folder = folder.replace("sf0.001", "sf0.01")
    grades = queries.op5_quality(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    row = grades.filter("held_out").agg(
        F.avg((F.col("selected") == (F.col("quality") == 1)).cast("double")).alias("right"),
        F.avg(F.when(F.col("quality") == 1, F.col("expected_grade"))).alias("good"),
        F.avg(F.when(F.col("quality") == 0, F.col("expected_grade"))).alias("bad"),
    ).first()
    assert row.right > 0.85 and row.good > row.bad + 0.5


def test_classifiers_without_labels_and_with_awkward_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, ""), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    odd = spark.createDataFrame([(1, None, 1), (None, 1, 1), (2, 1, 0), (2, 1, 0)], none.schema)
    for labels in (none, odd):
        assert toxicity.toxicity(docs, labels).count() == 4
        assert quality.quality(docs, quality.graded(labels)).count() == 4
    assert toxicity.toxicity(docs.filter("false"), odd).count() == 0


def test_sample_of_many_shuffle_partitions_is_staged_in_few_files(spark):
    """All its rows are there, equal sets of features once."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "concat('word', id % 1500, ' common') AS text")
    labels = spark.range(2000).selectExpr("id AS doc_id", "int(id % 3) AS label")
    held = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    try:
        found = learning.examples(docs, labels, shapes=True)
        assert len(found.inputFiles()) <= 24
        rows = found.collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    whole = learning.Features(True)
    expected = {}
    for n in range(2000):
        features = tuple(whole.of(b"word%d common" % (n % 1500)).tolist())
        expected[features] = max(n % 3, expected.get(features, 0))
    assert len(rows) == len(expected) and {tuple(r.features): r.label for r in rows} == expected


def test_machine_learns_a_pair_that_weights_cannot():
    """Label 1 only if both or neither of two features are there."""
    rng = np.random.default_rng(1)
    rows = [sorted(set(np.flatnonzero(rng.random(2) < 0.5).tolist()) | {2 + int(rng.integers(8))}) for _ in range(3000)]
    labels = np.array([(0 in r) == (1 in r) for r in rows], int)
    starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    model = learning.fit_machine(np.concatenate(rows), starts, labels, 10, rounds=60)
    right = (learning.machine_scores(model, np.concatenate(rows), starts) > 0) == labels
    assert right.mean() > 0.95


def test_toxicity_learns_a_pair_of_words_that_say_nothing_alone(spark):
    rng = np.random.default_rng(3)
    rows, truth = [], {}
    for doc in range(4000):
        one, two = (rng.random(2) < 0.5).tolist()
        filler = [f"w{n}" for n in rng.integers(0, 400, 12)]
        rows.append((doc, " ".join(filler + ["mention"] * one + ["insult"] * two), int(one == two)))
        truth[doc] = int(one == two)
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scored = toxicity.toxicity(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    got = scored.filter("held_out").collect()
    assert len(got) > 600 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in got]) > 0.95


def test_ordinal_thresholds_stay_in_order():
    rng = np.random.default_rng(2)
    grades = rng.integers(0, 4, 2000)
    rows = [[int(g), 4 + int(rng.integers(4))] for g in grades]
    starts = np.arange(0, 4001, 2)
    model = learning.fit_ordinal(np.concatenate(rows), starts, grades, 8, rounds=60)
    tails = learning.ordinal_tails(model, np.concatenate(rows), starts)
    assert (np.diff(model["thresholds"]) >= 0).all() and (np.diff(tails, axis=1) <= 1e-12).all()
    assert np.corrcoef(tails.sum(axis=1), grades)[0, 1] > 0.95


def test_pipeline_applies_every_decision(spark, folder, tmp_path):
    folder = folder.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, kept, folder)
        assert after.columns == columns
        after.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        before_ids = {r.doc_id for r in kept.select("doc_id").collect()}
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        if name == "toxicity":
            scored = toxicity.toxicity(kept, spark.read.parquet(f"{folder}/labels.parquet"))
            gone = {r.doc_id for r in scored.filter("predicted = 1").collect()}
            assert gone and ids == before_ids - gone
        elif name == "near_duplicates":
            groups = queries.near_duplicate_groups(kept)
            assert ids == {r.doc_id for r in groups.filter("doc_id = component_id").collect()}
            assert len(ids) < len(before_ids)
        elif name == "substring_dedup":
            again = queries.without_repeats(after).filter("n_removed > 0").count()
            assert again == 0 and ids <= before_ids
        else:
            judged = queries.contamination(kept, spark.read.parquet(f"{folder}/benchmark.parquet"))
            gone = {r.doc_id for r in judged.filter("contaminated").collect()}
            assert gone and ids == before_ids - gone
        kept = after
    rows = corpus_pipeline.STAGES[-1][1](spark, kept, folder).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in kept.collect()])
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "substring_dedup", "decontamination", "packing",
    ]


def test_sql_counterparts_on_the_small_tables(spark, folder):
    from tests.oracle_check import differences

    for name, sql in queries.ORACLES.items():
        assert differences(queries.QUERIES[name](spark, folder), folder, sql) == []


def test_pipeline_stages_on_odd_rows(spark, folder):
    """Null and repeated ids, null and empty texts, a column with a name used inside."""
    rows = [
        (1, "a b c", 0), (1, "a b c", 0), (None, "x y z w v u", 1), (None, "x y z w v u", 1),
        (2, None, 0), (2, "other words of a longer text", 3), (3, "", 0), (1, "another text", 4),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _doc int")
    one_each = [(1, "a b c", 0), (2, None, 0), (3, "", 0), (None, "x y z w v u", 1), (None, "x y z w v u", 1)]
    for name, step in corpus_pipeline.STAGES[:-1]:
        got = [tuple(r) for r in step(spark, docs, folder).collect()]
        expected = one_each if name == "near_duplicates" else rows
        assert sorted(got, key=str) == sorted(expected, key=str)
        assert step(spark, docs.limit(0), folder).isEmpty()


def test_texts_do_not_move_when_toxic_rows_are_dropped(spark):
    """Without broadcasts, as for many rejected rows; a column is named like one of the scorer."""
    docs = spark.range(400).selectExpr(
        "IF(id % 50 = 7, NULL, id) AS doc_id",
        "int(id) AS score",
        "concat(IF(id % 2 = 0, 'vile', 'kind'), ' word w', id, ' v', id * 7 % 101) AS text",
    )
    labels = spark.range(400).selectExpr("id AS doc_id", "1 - id % 2 AS toxic")
    scores = toxicity.toxicity(docs, labels, whole=True)
    assert {(r.text[:4], r.row.score % 2, r.predicted) for r in scores.collect()} == {("vile", 0, 1), ("kind", 1, 0)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table, corpus_pipeline.table = corpus_pipeline.table, lambda *_: labels
        left = corpus_pipeline.drop_toxic(spark, docs, "")
    finally:
        corpus_pipeline.table = table
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert left.columns == docs.columns and "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.score for r in left.collect()) == list(range(1, 400, 2))
