"""Near-duplicate groups by min-max hashing.

Every permutation of the shingle hashes gives two signature values, the smallest and the largest, so a
signature of 252 values costs 126 permutations. Bands of six values choose candidates. Links are
confirmed on the full shingle sets, and groups are connected components.

No step lists the pairs of a group. Documents with equal sets are one class from the start. In a band
bucket every class is compared with one hub, which leaves what it lacks of the hub's shingles and what
it has besides. Two classes that share no such difference are less alike than either is to the hub, so
what is left to compare are classes in different components. A few of them lead: each is compared with the
others of its hub, on the differences. The rest are compared where they share enough differences.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmon.llm.text import LOWERED, WordCodes, gram_codes, mixed, offsets, sliced, utf8
from sparkmon.session import broadcast_if_small, scratch, stage

SHINGLE = 5
PERMUTATIONS = 126
BAND_ROWS = 6
SIMILARITY = 85  # per cent
#: Open documents of a hub that are compared with all others of it before pairs are sought.
LEADS = 3

_rng = np.random.default_rng(20240131)
FACTORS = _rng.integers(0, 2**64, PERMUTATIONS, np.uint64) | np.uint64(1)
SHIFTS = _rng.integers(0, 2**64, PERMUTATIONS, np.uint64)

SKETCH = "doc_id long, n_shingles long, set_key binary, bands array<long>"
SET = "doc_id long, shingles array<long>"


def shingle_set(words: list[bytes], codes: WordCodes) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer words is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    coded = codes.codes(words)
    if len(words) < SHINGLE:
        return gram_codes(coded, len(words)) ^ np.uint64(len(words))
    return np.unique(gram_codes(coded, SHINGLE))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima and maxima per set; the sets must not be empty."""
    starts = offsets([len(s) for s in sets])[:-1]
    values = np.concatenate(sets)
    rows = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for number, (factor, shift) in enumerate(zip(FACTORS, SHIFTS, strict=True)):
        permuted = values * factor + shift
        rows[:, 2 * number] = np.minimum.reduceat(permuted, starts)
        rows[:, 2 * number + 1] = np.maximum.reduceat(permuted, starts)
    return rows


def band_hashes(rows: np.ndarray) -> np.ndarray:
    """A hash per band; bands take alternate minima and maxima of different permutations."""
    total = np.zeros((len(rows), rows.shape[1] // BAND_ROWS), np.uint64)
    width = total.shape[1]
    for step in range(BAND_ROWS):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, step * width : (step + 1) * width])
    return mixed(total + np.arange(width, dtype=np.uint64)).view(np.int64)


def _sets(batch: pa.RecordBatch, codes: WordCodes) -> list[np.ndarray]:
    return [shingle_set(t.translate(LOWERED).split(), codes) for t in utf8(batch.column("text"))]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = WordCodes()
    for batch in sliced(batches):
        sets = _sets(batch, codes)
        full = [i for i, s in enumerate(sets) if len(s)]
        bands = np.zeros((len(sets), 2 * PERMUTATIONS // BAND_ROWS), np.int64)
        if full:
            bands[full] = band_hashes(signatures([sets[i] for i in full]))
        keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        ends = np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(bands.ravel())),
            ],
            names=["doc_id", "n_shingles", "set_key", "bands"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = WordCodes()
    for batch in sliced(batches):
        sets = _sets(batch, codes)
        ends = offsets([len(s) for s in sets]).astype(np.int32)
        values = np.concatenate(sets).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
            names=["doc_id", "shingles"],
        )


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``id, label``: the smallest id that each id reaches over ``a, b`` edges.

    ``labels`` holds every id of the edges and the label known so far. Each round takes the smallest
    label among neighbours and then that label's own, so long chains shrink quickly. A round is written
    to the shared folder; it is joined with the edges, never gathered.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.distinct(), "edges")
    while True:
        heard = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(
            F.min("label").alias("heard")
        )
        near = labels.join(heard, labels.id == heard.a, "left").select(
            "id", F.col("label").alias("before"), F.least("label", F.coalesce("heard", "label")).alias("label")
        )
        near = stage(near, "labels-near")
        jump = near.select(F.col("id").alias("label"), F.col("label").alias("further"))
        moved = near.join(jump, "label", "left").select(
            "id", "before", F.least("label", F.coalesce("further", "label")).alias("label")
        )
        moved = stage(moved, "labels")
        labels = moved.select("id", "label")
        if moved.filter("before <> label").isEmpty():
            return labels


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The ``a, b`` pairs whose full sets are similar enough, compared as hash arrays."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.select("a", "b").join(right, "b").join(left, "a")
    sizes = joined.select(
        "a",
        "b",
        (F.size("left") + F.size("right")).alias("total"),
        F.size(F.array_intersect("left", "right")).alias("common"),
    )
    return sizes.filter(F.expr(f"100 * common >= {similarity} * (total - common)")).select("a", "b")


def differences(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Per ``hub, doc_id`` what the document lacks and has besides the hub, and whether they are linked.

    With ``n`` hub shingles, ``x`` lacking and ``y`` besides, the likeness is (n - x) / (n + y), so the
    two are linked if the burden 100 x + similarity y is at most (100 - similarity) n.
    """
    ours = sets.select("doc_id", F.col("shingles").alias("own"))
    theirs = sets.select(F.col("doc_id").alias("hub"), F.col("shingles").alias("base"))
    hubs = theirs.join(broadcast_if_small(stage(pairs.select("hub").distinct(), "hubs")), "hub", "left_semi")
    joined = pairs.select("hub", "doc_id").join(ours, "doc_id").join(hubs, "hub")
    apart = joined.select(
        "hub",
        "doc_id",
        F.size("base").alias("n"),
        F.array_except("base", "own").alias("lacks"),
        F.array_except("own", "base").alias("adds"),
    ).withColumns({"n_lacks": F.size("lacks"), "n_adds": F.size("adds")})
    burden = 100 * F.col("n_lacks") + similarity * F.col("n_adds")
    return apart.withColumn("burden", burden).withColumn(
        "linked", F.col("burden") <= (100 - similarity) * F.col("n")
    )


def near_duplicate_groups(documents: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Per document its number of shingles, its group's smallest id, and whether it is that one.

    A document without words has no shingles and is linked with nothing. Rows that share a ``doc_id``
    count as one document of the graph, each with its own number of shingles. A null ``doc_id`` is
    linked with nothing, has a null component and is kept. An empty table gives no rows; further
    columns are ignored.
    """
    with scratch(documents.sparkSession):
        texts = documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
        )
        sketches = stage(texts.mapInArrow(_sketch, SKETCH), "sketches", outlives=True)
        usable = sketches.filter("doc_id is not null and set_key is not null")
        classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
        members = usable.select("doc_id", "n_shingles", "set_key").join(classes, "set_key")
        members = stage(members, "members", outlives=True)
        reps = members.filter("doc_id = rep").select("doc_id").distinct()
        buckets = stage(
            usable.join(reps, "doc_id", "left_semi").select("doc_id", F.explode("bands").alias("bucket")),
            "buckets",
        )
        hubs = stage(
            buckets.groupBy("bucket")
            .agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last"))
            .filter("hub < last")
            .select("bucket", "hub"),
            "hubs",
        )
        pairs = buckets.join(hubs, "bucket").filter("hub <> doc_id").select("hub", "doc_id").distinct()
        pairs = stage(pairs, "hub-pairs")
        candidates = pairs.select("doc_id").unionByName(pairs.select(F.col("hub").alias("doc_id"))).distinct()
        candidates = stage(candidates, "candidates")
        wanted = texts.join(broadcast_if_small(candidates), "doc_id", "left_semi")
        sets = stage(wanted.mapInArrow(_full_sets, SET), "sets")

        apart = stage(differences(pairs, sets, similarity), "differences")
        edges = apart.filter("linked").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
        # Rows that share an id but not a text link the classes they are in.
        lowest = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
        split = lowest.filter("a < b").select("doc_id", "a")
        same = split.join(members, "doc_id").filter("rep > a").select("a", F.col("rep").alias("b")).distinct()
        edges = stage(edges.unionByName(same), "links")
        ends = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id")))
        known = candidates.select(F.col("doc_id").alias("id")).unionByName(ends).distinct()
        labels = components(edges, known.withColumn("label", F.col("id")))
        hubs_left = broadcast_if_small(uneven_hubs(placed(apart, labels)))
        uneven = stage(apart.join(hubs_left, "hub", "left_semi").drop("linked"), "uneven")
        for turn in range(LEADS):
            edges = stage(lead_links(uneven, labels, similarity, turn), "lead-links")
            if edges.isEmpty():
                break
            labels = merged(edges, labels)
        labels = linked(crossing(uneven, labels, similarity), labels, sets, similarity)
        labels = stage(labels, "labels", outlives=True)

    grouped = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("label", "rep").alias("component_id")
    )
    alone = sketches.filter("doc_id is null or set_key is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return grouped.unionByName(alone).withColumn("kept", kept)


def placed(apart: DataFrame, labels: DataFrame) -> DataFrame:
    """Sizes of the differences with the components of both sides, staged without the differences themselves.

    ``open`` documents are not in the hub's component.
    """
    mine = labels.select(F.col("id").alias("doc_id"), "label")
    hubs = labels.select(F.col("id").alias("hub"), F.col("label").alias("hub_label"))
    sizes = apart.select("hub", "doc_id", "n", "n_lacks", "n_adds", "burden")
    here = sizes.join(mine, "doc_id").join(hubs, "hub").withColumn("open", F.expr("label <> hub_label"))
    return stage(here.drop("hub_label"), "placed")


def uneven_hubs(here: DataFrame) -> DataFrame:
    """Hubs with an open document and documents of several components, which alone can hold further links."""
    per_hub = here.groupBy("hub").agg(
        F.max("open").alias("any_open"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    return stage(per_hub.filter("any_open AND low < high").select("hub"), "hubs")


def lead_links(apart: DataFrame, labels: DataFrame, similarity: int, turn: int) -> DataFrame:
    """Links between one open document of each hub, its lead, and the hub's other documents.

    A hub that is far from documents which are alike leaves them all open. Their lead joins them with one
    comparison each, on the differences from the hub: with ``s`` in common two documents are linked if
    (100 + similarity) s >= b1 + b2 - (100 - similarity) n. The first lead is the open document nearest to
    the hub, later ones are drawn by a hash. Sizes alone rule most comparisons out; differences are read for
    the others only.
    """
    here = placed(apart, labels)
    order = F.col("burden") if turn == 0 else F.xxhash64(F.col("doc_id"), F.lit(turn))
    first = here.filter("open").groupBy("hub").agg(F.min(F.struct(order, "doc_id")).alias("first"))
    chosen = stage(first.select("hub", F.col("first.doc_id").alias("lead")), "chosen")
    leads = here.join(broadcast_if_small(chosen), "hub").filter("doc_id = lead").select(
        "hub", "lead", *[F.col(c).alias(f"lead_{c}") for c in ("label", "burden", "n_lacks", "n_adds")]
    )
    least = F.col("burden") + F.col("lead_burden") - (100 - similarity) * F.col("n")
    most = F.least("n_lacks", "lead_n_lacks") + F.least("n_adds", "lead_n_adds")
    near = here.join(broadcast_if_small(stage(leads, "leads")), "hub").filter(
        (F.col("label") != F.col("lead_label")) & ((100 + similarity) * most >= least)
    )
    near = stage(near.select("hub", "doc_id", "lead", least.alias("least")), "near-leads")
    asked = stage(near.select("hub", F.col("lead").alias("doc_id")).distinct(), "asked")
    held = apart.select("hub", "doc_id", "lacks", "adds")
    theirs = held.join(broadcast_if_small(asked), ["hub", "doc_id"]).select(
        "hub",
        F.col("doc_id").alias("lead"),
        F.col("lacks").alias("lead_lacks"),
        F.col("adds").alias("lead_adds"),
    )
    ours = held.join(broadcast_if_small(near), ["hub", "doc_id"])
    both = ours.join(broadcast_if_small(stage(theirs, "lead-sets")), ["hub", "lead"])
    common = F.size(F.array_intersect("lacks", "lead_lacks")) + F.size(F.array_intersect("adds", "lead_adds"))
    alike = both.filter((100 + similarity) * common >= F.col("least"))
    return alike.select(F.col("lead").alias("a"), F.col("doc_id").alias("b")).distinct()


def crossing(apart: DataFrame, labels: DataFrame, similarity: int) -> DataFrame:
    """Pairs with a common hub but in different components that may still be similar enough.

    Let ``n`` be the hub's shingles and b the burdens of two documents. With s differences in common they
    are similar enough if (100 + similarity) s >= b1 + b2 - (100 - similarity) n. Of such a pair at least
    one is open, so its burden exceeds (100 - similarity) n. The other one shares more than
    b / (100 + similarity) of its differences, and the open one at least
    (b - (100 - similarity) n) / (100 + similarity) of its own.

    The differences of a hub have one order: first those that lead to no open document or are held once, then
    by the number of open documents that hold them. If two documents share m differences, then each one's
    first ``total - m + 1`` hold a shared one. So both sides are cut, and only documents that meet there are
    pairs. The number of shared differences is bounded by those not held once.
    """
    here = placed(apart, labels)
    here = here.join(broadcast_if_small(uneven_hubs(here)), "hub", "left_semi")
    marks = stage(here.select("hub", "doc_id", "open"), "marks")
    features = apart.join(broadcast_if_small(marks), ["hub", "doc_id"]).select(
        "hub",
        "doc_id",
        "open",
        F.explode(F.concat("lacks", "adds")).alias("difference"),
    )
    key = ["hub", "difference"]
    holders = features.groupBy(*key).agg(F.count("*").alias("all"), F.count_if("open").alias("open_ones"))
    known = features.join(holders.filter("all > 1 AND open_ones > 0").drop("all"), key)
    mine = Window.partitionBy("hub", "doc_id")
    ranked = known.withColumns(
        {
            "rank": F.row_number().over(mine.orderBy("open_ones", "difference")),
            "held": F.count("*").over(mine),
        }
    )
    facts = here.select("hub", "doc_id", "label", "open", "n", "n_lacks", "n_adds", "burden")
    limits = facts.withColumns(
        {
            "shared": F.expr(f"floor(burden / {100 + similarity}) + 1"),
            "shared_open": F.expr(
                f"greatest(1, ceil((burden - {100 - similarity} * n) / {100 + similarity}))"
            ),
        }
    )
    cut = ranked.drop("open").join(limits, ["hub", "doc_id"])
    sizes = ["label", "n_lacks", "n_adds", "held"]
    left = cut.filter("rank <= held - shared + 1").select(*key, "doc_id", *sizes)
    right = cut.filter("open AND rank <= held - shared_open + 1").select(
        *key, F.col("doc_id").alias("other"), *[F.col(c).alias(f"other_{c}") for c in sizes], "n"
    )
    lacking, adding = F.col("n_lacks") + F.col("other_n_lacks"), F.col("n_adds") + F.col("other_n_adds")
    least = 100 * lacking + similarity * adding - (100 - similarity) * F.col("n")
    common = F.least("n_lacks", "other_n_lacks") + F.least("n_adds", "other_n_adds")
    enough = (100 + similarity) * F.least("held", "other_held", common) >= least
    pairs = left.join(right, key).filter((F.col("label") != F.col("other_label")) & enough)
    return pairs.select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")).distinct()


def merged(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """The labels after joining components through their labels, so that all their members follow."""
    here = labels.select(F.col("id").alias("a"), F.col("label").alias("label_a"))
    there = labels.select(F.col("id").alias("b"), F.col("label").alias("label_b"))
    ends = edges.join(here, "a").join(there, "b").select(
        F.col("label_a").alias("a"), F.col("label_b").alias("b")
    )
    ends = stage(ends.distinct(), "merges")
    names = ends.select(F.col("a").alias("id")).unionByName(ends.select(F.col("b").alias("id"))).distinct()
    moved = components(ends, names.withColumn("label", F.col("id")))
    moved = moved.select(F.col("id").alias("label"), F.col("label").alias("further"))
    return stage(
        labels.join(moved, "label", "left").select("id", F.coalesce("further", "label").alias("label")),
        "labels",
    )


def linked(pairs: DataFrame, labels: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The labels after confirming those of the pairs that lie in different components."""
    edges = stage(confirmed(stage(pairs, "pairs"), sets, similarity), "links")
    return labels if edges.isEmpty() else merged(edges, labels)
