"""Inverted TF-IDF index on shared storage: built once, merged from increments, searched with pruning.

Each file of postings is ordered by token and falling impact, the document's own unit-length weight of the token,
and a token lies in one file unless it is very frequent, so a scan for a token above some impact reads few row
groups. Increments keep their raw counts, a row per document; merging adds up document frequencies and weighs the
counts anew, without reading a text or copying a count.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmon.functions.text import content, is_content, tokens
from sparkmon.operators.posting_blocks import Frequent, count_documents, count_tokens, merge_blocks
from sparkmon.session import broadcast_if_small, stage
from sparkmon.shipping import ship

SCORE_DECIMALS = 9
#: What rounding of scores may add to a bound.
SLACK = 1e-8
#: So many tokens, the most frequent ones, are looked up in place.
HOT_TOKENS = 200_000
#: Squared weight of the rarest tokens of a query that are summed up to raise its threshold.
LEAD = 0.25


@dataclass(frozen=True)
class TextIndex:
    """An index folder; what it is made of can be read as DataFrames."""

    spark: SparkSession
    path: str

    def _read(self, part: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{part}")

    @property
    def segments(self) -> list[str]:
        """Folders with the raw counts, one per increment."""
        return sorted(row.path for row in self._read("segments").collect())

    @property
    def counts(self) -> DataFrame:
        """``doc, token, tf`` of all increments."""
        return self.spark.read.parquet(*self.segments).select("doc", F.inline(F.arrays_zip("token", "tf")))

    @property
    def size(self) -> DataFrame:
        return self._read("size")

    @property
    def terms(self) -> DataFrame:
        """``token, df, idf, bound, best_doc``: the highest impact of a token and the first document that has it."""
        return self._read("terms")

    @property
    def postings(self) -> DataFrame:
        """``token, impact, doc``."""
        return self._read("postings").select("token", F.inline(F.arrays_zip("impact", "doc")))

    def postings_of(self, tokens: DataFrame) -> DataFrame:
        """``token, impact, doc`` of staged tokens; lists of other tokens are not taken apart."""
        lists = self._read("postings").join(broadcast_if_small(tokens), "token", "left_semi")
        return lists.select("token", F.inline(F.arrays_zip("impact", "doc")))


def _width(spark: SparkSession) -> int:
    """The shuffle width, asked for by number: few bytes of text or postings are much work, so tasks stay apart."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def build_index(
    corpus: DataFrame, doc_id: str, text: str, path: str, stop_words: list[str] | None = None
) -> TextIndex:
    """Index of a corpus. Rows that share an id are one document; rows without id or text have no postings.

    The texts are shuffled once, by document, and read no more.
    """
    spark = corpus.sparkSession
    ship(spark)
    texts = corpus.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).filter("doc IS NOT NULL")
    words = texts.repartition(_width(spark), "doc").sortWithinPartitions("doc").select("doc", content("text", stop_words).alias("token"))
    kind = texts.schema["doc"].dataType.simpleString()
    counted = words.mapInArrow(count_tokens, f"doc {kind}, token array<string>, tf array<bigint>")
    counted.write.parquet(f"{path}/counts")
    size = stage(corpus.agg(F.count(F.lit(1)).alias("n")), "corpus-size")
    counts = spark.read.schema(counted.schema).parquet(f"{path}/counts")
    frequencies = counts.select("token").mapInArrow(count_documents, "token string, df bigint")
    frequencies = frequencies.groupBy("token").agg(F.sum("df").alias("df"))
    return _weigh(spark, path, [f"{path}/counts"], size, frequencies)


def merge_indexes(indexes: list[TextIndex], path: str) -> TextIndex:
    """One index over the documents of several, which have no document in common.

    The new index refers to the counts of the old ones, which therefore have to stay.
    """
    spark = indexes[0].spark
    size, frequencies = indexes[0].size, indexes[0].terms.select("token", "df")
    for index in indexes[1:]:
        size = size.unionByName(index.size)
        frequencies = frequencies.unionByName(index.terms.select("token", "df"))
    segments = sorted({segment for index in indexes for segment in index.segments})
    total = size.agg(F.sum("n").alias("n"))
    return _weigh(spark, path, segments, total, frequencies.groupBy("token").agg(F.sum("df").alias("df")))


def _weigh(
    spark: SparkSession, path: str, segments: list[str], size: DataFrame, frequencies: DataFrame
) -> TextIndex:
    """Weigh the counts of all segments and write terms and postings.

    Frequent tokens are looked up in place, from a list whose length ``HOT_TOKENS`` bounds; a rare one holds so
    small a share that no partition of the shuffled join stands out. Norms meet the counts a row per document.
    The frequent tokens are transposed where their documents lie, so blocks of postings are shuffled and not
    single ones; slices of falling impact deal the most frequent tokens to several tasks.
    """
    ship(spark)
    spark.createDataFrame([(s,) for s in segments], "path string").coalesce(1).write.parquet(f"{path}/segments")
    size.coalesce(1).write.parquet(f"{path}/size")
    n = spark.read.parquet(f"{path}/size").select("n").scalar()
    idf = stage(frequencies.select("token", "df", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf")), "idf")
    listed = stage(idf.orderBy(F.desc("df"), "token").limit(HOT_TOKENS), "hot-idf")
    hot = Frequent(listed.toArrow())
    counts = spark.read.parquet(*segments)
    kind = counts.schema["doc"].dataType.simpleString()
    parts = stage(counts.mapInArrow(hot.squares, f"doc {kind}, token string, tf bigint, square double"), "squares")
    cold = idf.join(listed.select("token"), "token", "left_anti").select("token", "idf")
    rare = parts.filter("token IS NOT NULL").join(cold, "token")
    rare = stage(rare.select("doc", "token", (F.col("tf") * F.col("idf")).alias("raw")), "rare")
    squares = parts.filter("token IS NULL").select("doc", "square")
    squares = squares.unionByName(rare.select("doc", (F.col("raw") * F.col("raw")).alias("square")))
    norms = stage(squares.groupBy("doc").agg(F.sqrt(F.sum("square")).alias("norm")), "norms")
    shape = f"token string, slice bigint, impact array<double>, doc array<{kind}>"
    blocks = counts.join(norms, "doc").select("doc", "norm", "token", "tf").mapInArrow(hot.blocks, shape)
    impact, doc = F.array(F.col("raw") / F.col("norm")).alias("impact"), F.array("doc").alias("doc")
    singles = rare.join(norms, "doc").select("token", F.lit(0).cast("bigint").alias("slice"), impact, doc)
    order = ["token", "slice"]
    dealt = blocks.unionByName(singles).repartition(_width(spark), *order).sortWithinPartitions(*order)
    shape = f"token string, bound double, best_doc {kind}, impact array<double>, doc array<{kind}>"
    postings = dealt.mapInArrow(merge_blocks, shape)
    postings.write.parquet(f"{path}/postings")
    best = F.min(F.struct((-F.col("bound")).alias("negated"), F.col("best_doc").alias("doc"))).alias("best")
    bounds = spark.read.schema(postings.schema).parquet(f"{path}/postings").groupBy("token").agg(best)
    bounds = bounds.select("token", (-F.col("best.negated")).alias("bound"), F.col("best.doc").alias("best_doc"))
    idf.join(bounds, "token").write.parquet(f"{path}/terms")
    return TextIndex(spark, path)


def query_plan(
    index: TextIndex, queries: DataFrame, query_id: str, text: str, stop_words: list[str] | None = None
) -> DataFrame:
    """A row per query and token with its unit-length weight and what later tokens can still add.

    The tokens of a query are taken rarest first. ``rest_sum`` adds up the bounds of the later ones;
    ``rest_mass`` is the length of their part of the query, and no unit-length document adds more than that.
    """
    counts = (
        queries.select(query_id, F.explode(tokens(text)).alias("token"))
        .filter(is_content("token", stop_words))
        .groupBy(query_id, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    raw = counts.join(index.terms, "token").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(query_id)))
    weighed = raw.withColumn("weight", F.col("raw") / norm)
    order = Window.partitionBy(query_id).orderBy("df", "token")
    later = order.rowsBetween(1, Window.unboundedFollowing)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    square = F.col("weight") * F.col("weight")
    return weighed.select(
        query_id,
        "token",
        "weight",
        "bound",
        "best_doc",
        F.coalesce(F.sum(F.col("weight") * F.col("bound")).over(later), F.lit(0.0)).alias("rest_sum"),
        F.sqrt(F.coalesce(F.sum(square).over(later), F.lit(0.0))).alias("rest_mass"),
        F.coalesce(F.sum(square).over(earlier), F.lit(0.0)).alias("lead"),
    )


def reach(impact: Column) -> Column:
    """The highest score of a document whose first token of the query has this impact."""
    left = F.sqrt(F.greatest(F.lit(0.0), 1 - impact * impact)) * F.col("rest_mass")
    return F.col("weight") * impact + F.least(F.col("rest_sum"), left)


def partial_sums(index: TextIndex, plan: DataFrame, thresholds: DataFrame, query_id: str) -> DataFrame:
    """``query_id, doc, got, most``: what live tokens add up to, and the most that the score can be.

    A token is live if a document that has it first can still reach the threshold of the query. A document is
    judged at the first token that it shares with the query: earlier ones add nothing to it and later ones no
    more than the plan says. So one without a live token, or whose live postings all fall short, cannot win.
    What is not live adds at most its bounds, or what is left of the document's unit length. Postings of
    other tokens are not read.
    """
    floor = F.coalesce(F.col("threshold"), F.lit(0.0)) - SLACK
    # Both parts of the reach at their best: the impact at its bound, the rest as if nothing were used up.
    possible = F.col("weight") * F.col("bound") + F.least("rest_sum", "rest_mass") >= F.col("floor")
    ahead = plan.join(thresholds, query_id, "left").withColumn("floor", floor).withColumn("alive", possible)
    per_query = Window.partitionBy(query_id)
    idle = F.when(~F.col("alive"), F.col("weight"))
    live = ahead.withColumns(
        {
            "idle_sum": F.coalesce(F.sum(idle * F.col("bound")).over(per_query), F.lit(0.0)),
            "idle_mass": F.sqrt(F.coalesce(F.sum(idle * idle).over(per_query), F.lit(0.0))),
        }
    ).filter("alive")
    columns = [query_id, "token", "weight", "rest_sum", "rest_mass", "floor", "idle_sum", "idle_mass"]
    live = stage(live.select(columns), "live")
    met = index.postings_of(live.select("token")).join(broadcast_if_small(live), "token")
    sums = met.groupBy(query_id, "doc").agg(
        F.sum(F.col("weight") * F.col("impact")).alias("got"),
        F.sum(F.col("impact") * F.col("impact")).alias("used"),
        F.max(reach(F.col("impact"))).alias("reached"),
        *[F.max(c).alias(c) for c in ("floor", "idle_sum", "idle_mass")],
    )
    left = F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("used"))) * F.col("idle_mass")
    most = F.col("got") + F.least("idle_sum", left)
    return (
        sums.withColumn("most", most)
        .filter((F.col("reached") >= F.col("floor")) & (F.col("most") >= F.col("floor")))
        .select(query_id, "doc", "got", "most")
    )


def exact_scores(index: TextIndex, plan: DataFrame, pairs: DataFrame, query_id: str) -> DataFrame:
    """``query_id, doc, score`` of staged pairs, from the postings of their documents alone."""
    documents = stage(pairs.select("doc").distinct(), "candidates")
    wanted = stage(plan.select("token").distinct(), "query-tokens")
    postings = index.postings_of(wanted).join(broadcast_if_small(documents), "doc", "left_semi")
    asked = pairs.join(plan.select(query_id, "token", "weight"), query_id)
    total = F.round(F.sum(F.col("weight") * F.col("impact")), SCORE_DECIMALS)
    return asked.join(postings, ["token", "doc"]).groupBy(query_id, "doc").agg(total.alias("score"))


def leader_scores(index: TextIndex, plan: DataFrame, sums: DataFrame, query_id: str) -> DataFrame:
    """``query_id, threshold``: the score of the document that has got most so far."""
    leading = sums.groupBy(query_id).agg(F.max_by("doc", F.struct("got", "doc")).alias("doc"))
    scores = exact_scores(index, plan, stage(leading, "leading"), query_id)
    return scores.select(query_id, F.col("score").alias("threshold"))


def thresholds(index: TextIndex, plan: DataFrame, query_id: str) -> DataFrame:
    """A score per query that some document reaches.

    First the best document of each token is scored. What can beat that in the postings of the rarest tokens is
    added up, and the document with the largest part is scored too.
    """
    highest = F.max("score").alias("threshold")
    seeds = stage(plan.select(query_id, F.col("best_doc").alias("doc")).distinct(), "seeds")
    first = stage(exact_scores(index, plan, seeds, query_id).groupBy(query_id).agg(highest), "threshold")
    lead = partial_sums(index, plan.filter(F.col("lead") < LEAD), first, query_id)
    second = leader_scores(index, plan, lead, query_id)
    return stage(first.unionByName(second).groupBy(query_id).agg(F.max("threshold").alias("threshold")), "threshold")


def candidate_pairs(index: TextIndex, plan: DataFrame, query_id: str) -> DataFrame:
    """The distinct pairs that have to be scored to find every query's best document.

    The sums raise the threshold once more: the document with the largest one is scored before the others.
    """
    found = stage(partial_sums(index, plan, thresholds(index, plan, query_id), query_id), "sums")
    reached = leader_scores(index, plan, found, query_id).withColumnRenamed("threshold", "reached")
    reached = stage(reached, "reached")
    close = found.join(broadcast_if_small(reached), query_id).filter(F.col("most") >= F.col("reached") - SLACK)
    return stage(close.select(query_id, "doc"), "pairs")


def best_documents(
    index: TextIndex, queries: DataFrame, query_id: str, text: str, stop_words: list[str] | None = None
) -> DataFrame:
    """``query_id, doc, score``: the most similar document of each query that shares a token with one.

    Scores are compared after rounding to nine decimals; the lowest id wins a tie.
    """
    plan = stage(query_plan(index, queries, query_id, text, stop_words), "query-plan")
    pairs = candidate_pairs(index, plan, query_id)
    best = F.min(F.struct((-F.col("score")).alias("negated"), "doc")).alias("best")
    scores = exact_scores(index, plan, pairs, query_id).groupBy(query_id).agg(best)
    return scores.select(query_id, F.col("best.doc").alias("doc"), (-F.col("best.negated")).alias("score"))
