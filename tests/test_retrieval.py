"""TF-IDF against a direct computation, for broadcast and for shuffled joins."""

import math
import re
from collections import Counter

import pytest

from sparkmon.constants import STOP_WORDS
from sparkmon.functions.text import tokens
from sparkmon.operators.retrieval import cosine_scores, retrieve_best, term_weights

DOCS = {
    1: "Pump and valve. The pump leaks; pump seal worn_out 42",
    2: "valve seal, valve seat",
    3: "Über-Druck im Ventil: druck",
    4: "pump and valve. the PUMP leaks pump seal worn_out 42",
    5: "of the and",
}
QUERIES = {10: "pump leaks badly", 11: "Druck druck valve", 12: "nothing shared here", 13: "the of"}


def brute(docs, queries):
    def count(text):
        found = re.findall(r"\w\w+", text.lower())
        return Counter(t for t in found if t not in STOP_WORDS)

    tf = {d: count(t) for d, t in docs.items()}
    df = Counter(t for c in tf.values() for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}

    def unit(counts):
        raw = {t: n * idf[t] for t, n in counts.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw.values())) or 1.0
        return {t: v / norm for t, v in raw.items()}

    weights = {d: unit(c) for d, c in tf.items()}
    result = {}
    for q, text in queries.items():
        wq = unit(count(text))
        for d, wd in weights.items():
            result[q, d] = sum(w * wd.get(t, 0.0) for t, w in wq.items())
    return result


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame(list(DOCS.items()), "doc long, text string")
    queries = spark.createDataFrame(list(QUERIES.items()), "q long, words string")
    return docs, queries


@pytest.mark.parametrize(
    "threshold, hot, small",
    [("10MB", 9, False), ("10MB", 9, True), ("-1", 10**6, False), ("-1", 9, False), ("-1", 1, True)],
)
def test_scores_equal_brute_force(spark, frames, threshold, hot, small):
    docs, queries = frames
    expected = {k: v for k, v in brute(DOCS, QUERIES).items() if v > 0}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        scores = cosine_scores(docs, "doc", "text", queries, "q", "words", small_corpus=small, hot_tokens=hot)
        got = {(r["q"], r["doc"]): r["score"] for r in scores.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == pytest.approx(expected, abs=1e-8)


def test_best_takes_the_lowest_copy_and_falls_back_to_the_first(frames):
    docs, queries = frames
    best = {
        r["q"]: (r["doc"], r["score"])
        for r in retrieve_best(docs, "doc", "text", queries, "q", "words").collect()
    }
    scores = brute(DOCS, QUERIES)
    assert best[10] == (1, pytest.approx(scores[10, 1], abs=1e-8))  # 4 is a copy of 1
    assert best[11] == (3, pytest.approx(scores[11, 3], abs=1e-8))
    assert best[12] == (1, 0.0) and best[13] == (1, 0.0)


def test_named_documents_and_own_stop_words(spark):
    docs = spark.createDataFrame([("b", "pump seal"), ("a", "seal pump")], "name string, text string")
    queries = spark.createDataFrame([("x", "pump seal")], "q string, words string")
    best = retrieve_best(docs, "name", "text", queries, "q", "words", stop_words=["seal"]).collect()
    assert [(r["name"], r["score"]) for r in best] == [("a", 1.0)]
    terms = term_weights(docs, "text", stop_words=[]).collect()
    assert {r["token"]: r["df"] for r in terms} == {"pump": 2, "seal": 2}


def test_tokens_are_runs_of_two_or_more_word_characters(spark):
    df = spark.createDataFrame([("A b2 x_y Ünï-c 7 don't",)], "text string")
    assert df.select(tokens("text")).collect()[0][0] == ["b2", "x_y", "ünï", "don"]
