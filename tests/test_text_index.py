"""The inverted index: merging, pruned search against brute force, and how much is scored."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkmon.operators import posting_blocks, text_index
from sparkmon.operators.text_index import best_documents, build_index, candidate_pairs, merge_indexes, query_plan
from sparkmon.session import stage
from tests.test_retrieval import brute


@pytest.fixture(scope="module")
def texts():
    """Documents of a skewed vocabulary with copies, and queries that are pieces of some of them."""
    pick = random.Random(11)
    vocabulary = [f"w{i}" for i in range(600)]
    weights = [1 / (i + 1) for i in range(600)]
    docs = {i: " ".join(pick.choices(vocabulary, weights, k=pick.randrange(1, 60))) for i in range(300)}
    docs |= {300 + i: docs[i] for i in range(20)} | {400: "", 401: "of the", 402: "w0 " * 3000}
    queries = {i: " ".join(docs[i * 7].split()[: 4 + i]) + " w0 w1 odd" for i in range(30)}
    return docs, queries | {90: "nothing known", 91: "w0", 92: " ".join(vocabulary)}


def frames(spark, texts):
    docs, queries = texts
    return (
        spark.createDataFrame([*docs.items(), (500, None), (None, "w3 w4")], "id long, body string"),
        spark.createDataFrame(list(queries.items()), "q long, words string"),
    )


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("threshold, hot", [("10MB", 20_000), ("-1", 1)])
def test_best_documents_equal_brute_force(spark, texts, tmp_path, monkeypatch, threshold, hot):
    monkeypatch.setattr(text_index, "HOT_TOKENS", hot)
    docs, queries = texts
    # Rows without id or text count as documents of the corpus but have no postings.
    scores = brute(docs | {500: "", 501: ""}, queries)
    expected = []
    for q in queries:
        best = min((-round(scores[q, d], 9), d) for d in docs)
        if best[0] < 0:
            expected.append((q, best[1], pytest.approx(-best[0], abs=2e-9)))
    corpus, asked = frames(spark, texts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        index = build_index(corpus, "id", "body", str(tmp_path / "index"))
        assert rows(best_documents(index, asked, "q", "words"), "q", "doc", "score") == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merged_increments_equal_the_whole(spark, texts, tmp_path):
    corpus, asked = frames(spark, texts)
    whole = build_index(corpus, "id", "body", str(tmp_path / "whole"))
    parts = [
        build_index(corpus.filter(F.coalesce("id", F.lit(0)) % 3 == i), "id", "body", str(tmp_path / f"part{i}"))
        for i in range(3)
    ]
    first = merge_indexes(parts[:2], str(tmp_path / "first"))
    merged = merge_indexes([first, parts[2]], str(tmp_path / "merged"))
    assert len(merged.segments) == 3
    for index in (whole, merged):
        assert index.postings.count() == index.counts.count()
    exact = [("token", "df", "best_doc"), ("token", "idf", "bound")]
    assert rows(whole.terms, *exact[0]) == rows(merged.terms, *exact[0])
    for a, b in zip(rows(whole.terms, *exact[1]), rows(merged.terms, *exact[1]), strict=True):
        assert a == (b[0], pytest.approx(b[1]), pytest.approx(b[2]))
    assert rows(best_documents(whole, asked, "q", "words"), "q", "doc") == rows(
        best_documents(merged, asked, "q", "words"), "q", "doc"
    )


def test_postings_are_clustered_by_token_and_falling_impact(spark, texts, tmp_path):
    corpus, _ = frames(spark, texts)
    index = build_index(corpus, "id", "body", str(tmp_path / "index"))
    ordered = index.postings.select("token", "impact", F.input_file_name().alias("file")).collect()
    by_file = {}
    for row in ordered:
        by_file.setdefault(row.file, []).append((row.token, -row.impact))
    assert all(part == sorted(part) for part in by_file.values())
    lengths = index.postings.groupBy("doc").agg(F.sum(F.col("impact") * F.col("impact")).alias("n")).collect()
    assert all(r.n == pytest.approx(1) for r in lengths)


def test_few_pairs_are_scored(spark, folder, tmp_path):
    folder = folder.replace("sf0.001", "sf0.01")
    corpus, queries = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark"))
    index = build_index(corpus, "doc_id", "text", str(tmp_path / "index"))
    plan = stage(query_plan(index, queries, "item_id", "text"), "plan")
    sharing = index.postings.join(plan.select("item_id", "token"), "token").select("item_id", "doc").distinct()
    scored = candidate_pairs(index, plan, "item_id").count()
    assert scored < corpus.count() * queries.count() / 10 and scored < sharing.count() / 4


def test_an_empty_corpus_has_no_best_documents(spark, texts, tmp_path):
    corpus, asked = frames(spark, texts)
    index = build_index(corpus.limit(0), "id", "body", str(tmp_path / "index"))
    assert best_documents(index, asked, "q", "words").collect() == [] and index.terms.count() == 0


def test_postings_are_shuffled_and_kept_as_lists(spark, texts, tmp_path, monkeypatch):
    corpus, _ = frames(spark, texts)
    for hot in (200_000, 50):
        monkeypatch.setattr(text_index, "HOT_TOKENS", hot)
        index = build_index(corpus, "id", "body", str(tmp_path / f"index{hot}"))
        lists = spark.read.parquet(f"{index.path}/postings")
        assert lists.count() == index.terms.count() < index.postings.count() / 5
        assert lists.filter("bound <> impact[0] OR best_doc <> doc[0]").count() == 0


def test_texts_that_share_an_id_are_one_document(spark, tmp_path):
    """Also where they come in different batches."""
    rows_of_7 = [(7, f"aa b{i % 3}") for i in range(10)]
    corpus = spark.createDataFrame([*rows_of_7, (1, "aa"), (8, "aa cc"), (9, None), (None, "aa")], "id long, body string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        index = build_index(corpus, "id", "body", str(tmp_path / "index"))
        counted = {(r.doc, r.token): r.tf for r in index.counts.collect()}
        assert index.counts.count() == len(counted)
        assert counted == {(7, "aa"): 10, (7, "b0"): 4, (7, "b1"): 3, (7, "b2"): 3, (1, "aa"): 1, (8, "aa"): 1, (8, "cc"): 1}
        assert {r.token: r.df for r in index.terms.collect()} == {"aa": 3, "b0": 1, "b1": 1, "b2": 1, "cc": 1}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_slices_of_frequent_tokens_and_pieces_of_long_lists(spark, texts, tmp_path, monkeypatch):
    corpus, _ = frames(spark, texts)
    whole = build_index(corpus, "id", "body", str(tmp_path / "whole"))
    monkeypatch.setattr(posting_blocks, "SLICED", 10)
    monkeypatch.setattr(posting_blocks, "PIECE", 3)
    hot = posting_blocks.Frequent(whole.terms.select("token", "idf", "df").toArrow())
    norms = whole.counts.join(whole.terms, "token").groupBy("doc").agg(F.sqrt(F.sum(F.expr("pow(tf * idf, 2)"))).alias("norm"))
    counts = spark.read.parquet(*whole.segments).join(norms, "doc").select("doc", "norm", "token", "tf").toArrow()
    blocks = pa.Table.from_batches(hot.blocks(counts.to_batches(max_chunksize=40)))
    blocks = blocks.sort_by([("token", "ascending"), ("slice", "ascending")])
    merged = pa.Table.from_batches(posting_blocks.merge_blocks(blocks.to_batches(max_chunksize=50))).to_pylist()
    assert max(r["slice"] for r in blocks.to_pylist()) > 0 and max(len(r["doc"]) for r in merged) == 3
    flat = [(r["token"], i, d) for r in merged for i, d in zip(r["impact"], r["doc"], strict=True)]
    expected = sorted(rows(whole.postings, "token", "impact", "doc"), key=lambda r: (r[0], -r[1], r[2]))
    assert [(t, round(-i, 9)) for t, i, _ in flat] == [(t, round(-i, 9)) for t, i, _ in expected]
    assert sorted((t, d) for t, _, d in flat) == sorted((t, d) for t, _, d in expected)
