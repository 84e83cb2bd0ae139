"""Hashed text features and two small models fitted on a bounded sample of labelled documents.

Only fitting is bounded: at most about ``SAMPLE_ROWS`` labelled rows, chosen by a hash of their id, and
``FEATURES`` features. Those whose mean label lies ``LEAST_DISTANCE`` standard errors off come first, then those
that most documents have, whatever their labels. How much each counts is left to a penalty of ``PENALTY``
standard errors of its gradient, which takes weights that say nothing to zero. Scoring reads every
document whole.
"""

import operator
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon.llm.text import ALNUM, LOWERED, MEMO_ENTRIES, offsets, sliced, utf8
from sparkmon.session import stage

HASH_BITS = 18
SAMPLE_ROWS = 24_000
#: The staged sample has one file at most for so many of the rows it is bounded by.
FILE_ROWS = 1_000
FEATURES = 20_000
LEAST_DOCUMENTS = 3
LEAST_DISTANCE = 6.0
PENALTY = 1.0
#: Steps of a fit at least, so that few labels are learned as far as many.
STEPS = 1_000
PREFIX = 5
FACTORS = 8

EXAMPLE = "label int, features array<int>"


def hashed(term: bytes) -> bytes:
    return (xxhash.xxh3_64_intdigest(term) >> (64 - HASH_BITS)).to_bytes(4, "little")


class Features(dict):
    """Hashed features of a text, one for every distinct term.

    Terms are lower-case words and the first letters of longer ones. With ``shapes`` they are the text's
    white-space tokens, the length of each with the punctuation in it, and how much of the text repeats
    the token before.
    """

    def __init__(self, shapes: bool):
        super().__init__()
        self.shapes = shapes

    def __missing__(self, word: bytes) -> bytes:
        letters = word.decode("utf-8", "replace")
        terms = [word]
        if self.shapes:
            marks = bytes(b for b in word if b < 0x80 and not chr(b).isalnum())
            terms.append(b"\x00%d %s" % (min(len(letters) - len(marks), 20), marks[:4]))
        elif len(letters) > PREFIX:
            terms.append(b"\x01" + letters[:PREFIX].encode())
        found = self[word] = b"".join(map(hashed, terms))
        return found

    def of(self, text: bytes) -> np.ndarray:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        words = text.translate(LOWERED if self.shapes else ALNUM).split()
        found = list(map(self.__getitem__, words))
        if self.shapes and words:
            repeated = sum(map(operator.eq, words, words[1:]))
            found.append(hashed(b"\x02%d" % (10 * repeated // len(words))))
        return np.unique(np.frombuffer(b"".join(found), np.int32))


def _examples(shapes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(shapes)
        for batch in sliced(batches):
            found = [features.of(text) for text in utf8(batch.column("text"))]
            ends = offsets([len(f) for f in found]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), lists], names=["label", "features"]
            )

    return run


def examples(documents: DataFrame, labels: DataFrame, shapes: bool, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Staged ``features, label`` of about ``rows`` labelled documents at most.

    ``labels`` has ``doc_id, label``; rows without either are left out.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label")
    ).dropna()
    total = known.count()
    share = min(1.0, rows / max(1, total))
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = F.broadcast(known.filter(chosen).dropDuplicates(["doc_id"]))  # bounded by ``rows``
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    found = texts.join(sample, "doc_id").select("label", "text")
    hashed_texts = found.mapInArrow(_examples(shapes), EXAMPLE)
    # Copies would pass for many independent documents.
    single = hashed_texts.groupBy("features").agg(F.max("label").alias("label"))
    # A file for each of many shuffle partitions would cost executors more memory than the bounded sample.
    return stage(single.coalesce(-(-rows // FILE_ROWS)), "examples")


def telling_features(found: DataFrame) -> DataFrame:
    """Features whose documents' mean label is far from the mean, in standard errors, then the most frequent.

    A term can matter only together with another one, so frequent terms take part whatever their mean.
    """
    whole = found.agg(F.avg("label"), F.stddev_pop("label")).first()
    mean, spread = (float(v or 0.0) for v in whole)
    by_feature = (
        found.select("label", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("n"), F.avg("label").alias("mean"))
        .filter(F.col("n") >= LEAST_DOCUMENTS)
    )
    distance = F.abs(F.col("mean") - mean) * F.sqrt("n") / (spread or 1.0)
    alone = F.when(distance >= LEAST_DISTANCE, distance)
    return by_feature.orderBy(alone.desc_nulls_last(), F.desc("n"), "feature").limit(FEATURES).select("feature")


def fitted(
    documents: DataFrame,
    labels: DataFrame,
    fit: Callable[[np.ndarray, np.ndarray, np.ndarray, int], dict[str, np.ndarray]],
    shapes: bool,
) -> dict[str, np.ndarray]:
    """A model fitted in one task on the bounded sample, as arrays of bounded size."""
    found = examples(documents, labels, shapes)
    chosen = np.sort(np.array([r.feature for r in telling_features(found).collect()], np.int32))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, counts, graded = [], [], []
        for batch in batches:
            for features in batch["features"]:
                here = known_places(chosen, np.asarray(features, np.int32))
                kept.append(here)
                counts.append(len(here))
            graded += batch["label"].tolist()
        if graded:
            arrays = fit(np.concatenate(kept), offsets(counts), np.array(graded), len(chosen))
            yield pd.DataFrame(
                {"name": list(arrays), "value": [v.astype(np.float32).tobytes() for v in arrays.values()]}
            )

    rows = found.coalesce(1).mapInPandas(run, "name string, value binary").collect()
    model = {row.name: np.frombuffer(row.value, np.float32) for row in rows}
    return used({"features": chosen, **model})


def used(model: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The same model without the features that add nothing to any score."""
    if "weights" not in model:
        return model
    alive = model["weights"] != 0
    if "vectors" in model:
        vectors = model["vectors"].reshape(-1, FACTORS)
        alive = alive | vectors.any(axis=1)
        model = model | {"vectors": vectors[alive].ravel()}
    return model | {"features": model["features"][alive], "weights": model["weights"][alive]}


def known_places(chosen: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Places in ``chosen`` (sorted) of those features that are in it."""
    places = np.searchsorted(chosen, features)
    inside = places < len(chosen)
    return places[inside][chosen[places[inside]] == features[inside]]


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive starts along the first axis; empty ones are 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0)])
    return total[starts[1:]] - total[starts[:-1]]


class Adam:
    def __init__(self, shape, rate: float):
        self.first, self.second = np.zeros(shape), np.zeros(shape)
        self.rate, self.step = rate, 0

    def move(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.first += 0.1 * (gradient - self.first)
        self.second += 0.001 * (gradient**2 - self.second)
        first = self.first / (1 - 0.9**self.step)
        second = self.second / (1 - 0.999**self.step)
        return self.rate * first / (np.sqrt(second) + 1e-8)

    def shrunk(self, values: np.ndarray, gradient: np.ndarray, penalty: np.ndarray) -> np.ndarray:
        """The values after a step, and by the penalty on their sizes nearer to zero."""
        moved = values - self.move(gradient)
        second = self.second / (1 - 0.999**self.step)
        return np.sign(moved) * np.maximum(np.abs(moved) - self.rate * penalty / (np.sqrt(second) + 1e-8), 0)


def batches_of(places: np.ndarray, starts: np.ndarray, rounds: int, size: int = 512):
    """Shuffled minibatches as ``(documents, places, starts)``."""
    rng = np.random.default_rng(7)
    lengths = np.diff(starts)
    for _ in range(rounds):
        order = rng.permutation(len(lengths))
        for at in range(0, len(order), size):
            docs = order[at : at + size]
            inner = offsets(lengths[docs])
            pick = np.repeat(starts[docs] - inner[:-1], lengths[docs]) + np.arange(inner[-1])
            yield docs, places[pick], inner


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def machine_scores(model: dict[str, np.ndarray], places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Linear and pairwise part of a factorization machine over present features."""
    vectors = model["vectors"].reshape(-1, FACTORS)[places].astype(np.float64)
    sums = segment_sums(vectors, starts)
    squares = segment_sums((vectors**2).sum(axis=1), starts)
    linear = segment_sums(model["weights"][places].astype(np.float64), starts)
    return float(model["bias"][0]) + linear + 0.5 * ((sums**2).sum(axis=1) - squares)


def rounds_of(rounds: int, rows: int, size: int = 512) -> int:
    return max(rounds, -(-STEPS // -(-rows // size)))


def penalties(places: np.ndarray, width: int, errors: np.ndarray) -> np.ndarray:
    """``PENALTY`` standard errors of each weight's gradient while nothing is learned."""
    return PENALTY * errors.std() * np.sqrt(np.bincount(places, minlength=width)) / len(errors)


def telling_pairs(places: np.ndarray, starts: np.ndarray, width: int, rest: np.ndarray, chance: np.ndarray):
    """Whether a feature is in any pair whose documents the weights alone leave far from their labels.

    ``rest`` is label less probability and ``chance`` its variance. The distance of a pair is the sum of
    ``rest`` over its documents in standard errors, one document's worth added, so a pair
    in fewer than ``LEAST_DISTANCE`` squared documents of even chance needs clear labels.
    """
    paired = np.zeros(width, bool)
    counts = np.bincount(places, minlength=width)
    order = np.argsort(places, kind="stable")
    bounds = offsets(counts.tolist())
    rows = np.searchsorted(starts, order, "right") - 1
    ends = starts[rows + 1]
    for feature in np.flatnonzero(counts >= LEAST_DISTANCE):  # the sum is at most the count
        total, spread = np.zeros(width), np.ones(width)
        for at in range(bounds[feature], bounds[feature + 1], 4096):
            here = slice(at, min(at + 4096, bounds[feature + 1]))
            first = order[here] + 1  # places of a row ascend, so every pair comes once
            lengths = ends[here] - first
            inner = offsets(lengths)
            others = places[np.repeat(first - inner[:-1], lengths) + np.arange(inner[-1])]
            total += np.bincount(others, np.repeat(rest[rows[here]], lengths), width)
            spread += np.bincount(others, np.repeat(chance[rows[here]], lengths), width)
        far = np.abs(total) >= LEAST_DISTANCE * np.sqrt(spread)
        paired |= far
        paired[feature] |= far.any()
    return paired


def fit_machine(
    places: np.ndarray, starts: np.ndarray, labels: np.ndarray, width: int, rounds: int = 20
) -> dict[str, np.ndarray]:
    """Factorization machine for 0/1 labels: logistic loss, minibatches, penalised weights.

    Weights are fitted first. Vectors are learned for the features of pairs that still tell something
    then, and stay zero for others, whose products would only fit noise.
    """
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    model = {
        "bias": np.array([np.log(share / (1 - share))]),
        "weights": np.zeros(width),
        "vectors": np.zeros(width * FACTORS),
    }
    rounds = rounds_of(rounds, len(labels))
    penalty = penalties(places, width, labels - share)
    moves = {"bias": Adam(1, 0.01), "weights": Adam(width, 0.02)}
    for docs, here, inner in batches_of(places, starts, rounds):
        linear = segment_sums(model["weights"][here], inner)
        error = (sigmoid(model["bias"] + linear) - labels[docs]) / len(docs)
        model["bias"] -= moves["bias"].move(np.array([error.sum()]))
        slope = np.bincount(here, np.repeat(error, np.diff(inner)), width)
        model["weights"] = moves["weights"].shrunk(model["weights"], slope, penalty)
    chance = sigmoid(model["bias"] + segment_sums(model["weights"][places], starts))
    paired = telling_pairs(places, starts, width, labels - chance, chance * (1 - chance))
    if not paired.any():
        return model
    slots = np.cumsum(paired) - 1
    vectors = np.random.default_rng(11).normal(0, 0.01, (int(paired.sum()), FACTORS))
    moves["vectors"] = Adam(vectors.shape, 0.005)
    for docs, here, inner in batches_of(places, starts, rounds):
        inside = paired[here]
        edges = np.concatenate([[0], np.cumsum(inside)])[inner]
        slot = slots[here[inside]]
        mine = vectors[slot]
        sums = segment_sums(mine, edges)
        products = 0.5 * ((sums**2).sum(axis=1) - segment_sums((mine**2).sum(axis=1), edges))
        linear = segment_sums(model["weights"][here], inner)
        error = (sigmoid(model["bias"] + linear + products) - labels[docs]) / len(docs)
        pull = np.repeat(error, np.diff(edges))[:, None] * (np.repeat(sums, np.diff(edges), axis=0) - mine)
        slope = np.stack([np.bincount(slot, pull[:, f], len(vectors)) for f in range(FACTORS)], axis=1)
        vectors = vectors - moves["vectors"].move(slope + 1e-5 * vectors)
        model["bias"] -= moves["bias"].move(np.array([error.sum()]))
        slope = np.bincount(here, np.repeat(error, np.diff(inner)), width)
        model["weights"] = moves["weights"].shrunk(model["weights"], slope, penalty)
    everywhere = np.zeros((width, FACTORS))
    everywhere[paired] = vectors
    return model | {"vectors": everywhere.ravel()}


def ordinal_tails(model: dict[str, np.ndarray], places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """P(grade > k) for every threshold k, from one score and ordered thresholds."""
    score = segment_sums(model["weights"][places].astype(np.float64), starts)
    return sigmoid(score[:, None] - model["thresholds"].astype(np.float64)[None, :])


def fit_ordinal(
    places: np.ndarray, starts: np.ndarray, grades: np.ndarray, width: int, rounds: int = 20
) -> dict[str, np.ndarray]:
    """Cumulative-link regression for grades 0..K: shared weights, thresholds kept in order."""
    top = max(1, int(grades.max()))
    above = np.clip([(grades > k).mean() for k in range(top)], 1e-3, 1 - 1e-3)
    model = {"weights": np.zeros(width), "thresholds": np.sort(-np.log(above / (1 - above)))}
    moves = {"weights": Adam(width, 0.02), "thresholds": Adam(top, 0.01)}
    # Without weights the error of a grade is the sum of its two tails less one.
    bounds = np.concatenate([[1.0], sigmoid(-model["thresholds"]), [0.0]])
    penalty = penalties(places, width, bounds[grades] + bounds[grades + 1] - 1)
    for docs, here, inner in batches_of(places, starts, rounds_of(rounds, len(grades))):
        tails = ordinal_tails(model, here, inner)
        grade = grades[docs]
        # Likelihood of a grade: difference of neighbouring tails, whose slopes are p (1 - p).
        padded = np.concatenate([np.ones((len(docs), 1)), tails, np.zeros((len(docs), 1))], axis=1)
        slopes = padded * (1 - padded)
        row = np.arange(len(docs))
        likely = np.maximum(padded[row, grade] - padded[row, grade + 1], 1e-9)
        error = -(slopes[row, grade] - slopes[row, grade + 1]) / likely / len(docs)
        shift = np.zeros((len(docs), top + 2))
        shift[row, grade] += slopes[row, grade] / likely / len(docs)
        shift[row, grade + 1] -= slopes[row, grade + 1] / likely / len(docs)
        slope = np.bincount(here, np.repeat(error, np.diff(inner)), width)
        model["weights"] = moves["weights"].shrunk(model["weights"], slope, penalty)
        moved = model["thresholds"] - moves["thresholds"].move(shift[:, 1:-1].sum(axis=0))
        model["thresholds"] = np.maximum.accumulate(moved)
    return model


def scorer(shared, shapes: bool, carried: list[str], score, empty, names: list[str]):
    """Adds to the carried columns what ``score`` gives per document, from arrays to columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        features = Features(shapes)
        for batch in sliced(batches):
            if "weights" not in model:
                columns = empty(batch.num_rows)
            else:
                here = [
                    known_places(model["features"], features.of(text))
                    for text in utf8(batch.column("text"))
                ]
                columns = score(model, np.concatenate(here), offsets([len(h) for h in here]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), *map(pa.array, columns)], names=[*carried, *names]
            )

    return run
