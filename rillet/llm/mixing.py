"""Mix sources to target weights by nested hash thresholds.

Each document gets a hash of its id.  A source contributes its documents whose hash lies below a
threshold; a target of more than the whole source takes all documents once or twice and those below
the threshold once more.  Thresholds come from histograms: words are summed by source and hash
bucket, the bucket in which the budget ends is split again by the next bits of the hash, and only
that bucket.  Documents are never sorted, and a larger budget takes a superset of a smaller one.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.common import WORD, checkpointed, salts

HASH_BITS = 60
#: The rows of a table of sources up to which it is broadcast; beyond that it is joined by salts.
BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class Mix:
    """What a mix should be.

    weights: of the sources by code point of their names, null last; repeated as needed.
    share: of the words of all documents that the mix should hold.
    max_repeats: no source gives more than so many times its words, no document more than so many
        copies; what a source cannot give goes to the others by weight.
    bits: hash bits of each histogram, from the highest.
    """

    weights: tuple = (5, 2, 1)
    share: float = 1.0
    max_repeats: int = 3
    bits: tuple = (12, 12, 12)
    seed: str = "mix"


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def position(doc_id: Column, seed: str) -> Column:
    """The place of a document in the order in which its source is taken: 60 bits of an MD5."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The level is the number of words per unit of weight; sources whose limit lies below the level
    stop there.  A source stops exactly if the budget suffices to fill all sources to its limit.
    """
    every = Window.partitionBy()
    by_limit = Window.partitionBy().orderBy("_ratio")
    names = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*(F.lit(float(weight)) for weight in mix.weights))
    rows = (
        sources.withColumn("_rank", (F.row_number().over(names) - 1) % len(mix.weights))
        .withColumn("_weight", F.element_at(weights, F.col("_rank") + 1))
        .withColumn("_limit", (F.col("source_size") * mix.max_repeats).cast("double"))
        .withColumn("_ratio", F.col("_limit") / F.col("_weight"))
        .withColumn("_budget", F.sum("source_size").over(every) * F.lit(float(mix.share)))
        .withColumn("_above", F.sum("_weight").over(every) - F.sum("_weight").over(by_limit))
        .withColumn(
            "_stops",
            F.sum("_limit").over(by_limit) + F.col("_ratio") * F.col("_above") <= F.col("_budget"),
        )
        .withColumn("_given", F.sum(F.when(F.col("_stops"), F.col("_limit")).otherwise(0.0)).over(every))
        .withColumn("_rest", F.sum(F.when(F.col("_stops"), 0.0).otherwise(F.col("_weight"))).over(every))
    )
    filled = F.col("_weight") * ((F.col("_budget") - F.col("_given")) / F.col("_rest"))
    return rows.select(
        "source", "source_size", F.when(F.col("_stops"), F.col("_limit")).otherwise(filled).alias("target")
    )


def with_source(rows: DataFrame, table: DataFrame, n_sources: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per source.

    A table of up to BROADCAST_SOURCES rows is broadcast, so the rows are not shuffled.  A larger one
    is repeated for a number of salts, so a hot source is not joined in one task.
    """
    table = table.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    if n_sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(table), same).drop("_source")
    parts = salts(rows.sparkSession)
    salted = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    rows = rows.withColumn("_salt", F.pmod(F.col("hash"), F.lit(parts)).cast("int"))
    return rows.join(salted, same & (F.col("_salt") == F.col("_part"))).drop("_source", "_salt", "_part")


def thresholds(sized: DataFrame, mix: Mix) -> tuple[DataFrame, int]:
    """(source, source_size, target, whole, threshold) and the number of sources.

    ``sized`` holds (source, size, hash) and is read once per histogram.  ``whole`` is how often all
    documents are taken; those with a hash below ``threshold`` are taken once more.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = checkpointed(
        targets(sources, mix)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("_need", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    n_sources = plan.count()
    at = plan.select("source", F.lit(0).cast("long").alias("_path"), "_need")
    left = HASH_BITS
    for bits in mix.bits:
        inside = with_source(sized, at, n_sources).filter(
            F.shiftright("hash", left) == F.col("_path")
        )
        left -= bits
        histogram = inside.groupBy("source", "_need", F.shiftright("hash", left).alias("_path")).agg(
            F.sum("size").alias("_size")
        )
        below = F.sum("_size").over(Window.partitionBy("source").orderBy("_path")) - F.col("_size")
        at = checkpointed(
            histogram.withColumn("_below", below)
            .filter((F.col("_below") <= F.col("_need")) & (F.col("_below") + F.col("_size") > F.col("_need")))
            .select("source", "_path", "_size", (F.col("_need") - F.col("_below")).alias("_need"))
        )
    nearer = (F.col("_size") - F.col("_need") < F.col("_need")).cast("long")
    ends = at.select(
        F.col("source").alias("_source"),
        F.shiftleft(F.col("_path") + nearer, left).alias("_end"),
    )
    plan = plan.join(ends, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source",
        "source_size",
        "target",
        F.col("whole").cast("long").alias("whole"),
        F.coalesce("_end", F.lit(1 << HASH_BITS)).alias("threshold"),
    )
    return checkpointed(plan), n_sources


def mix_documents(
    docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the document and ``taken`` the words that makes.  A null
    text has size 0; null is a source of its own; documents with equal ids (also null ids) have
    equal hashes and are taken together; documents without words are taken like others and add
    nothing.  An empty table gives an empty result.  Other columns are not read.

    The words taken of a source differ from its target by half of a document at most, as long as
    few documents share the bits of all histograms.
    """
    sized = checkpointed(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            words(F.col(text)).alias("size"),
            position(F.col(doc_id), mix.seed).alias("hash"),
        )
    )
    plan, n_sources = thresholds(sized, mix)
    copies = F.col("whole") + (F.col("hash") < F.col("threshold")).cast("long")
    return with_source(sized, plan, n_sources).select(
        "doc_id", "source", "size", "source_size", "target",
        copies.alias("copies"), (F.col("size") * copies).alias("taken"),
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents that the mix takes, with all their columns and ``copies``.

    A column named copies in ``docs`` is replaced.  Nulls and ties as in ``mix_documents``.
    """
    hashed = position(F.col("doc_id"), mix.seed).alias("hash")
    plan, n_sources = thresholds(
        checkpointed(docs.select("source", words(F.col("text")).alias("size"), hashed)), mix
    )
    # The row travels as one column, so none of its columns can clash with those of the plan.
    rows = docs.drop("copies").select(F.struct("*").alias("row"), "source", hashed)
    copies = F.col("whole") + (F.col("hash") < F.col("threshold")).cast("long")
    return (
        with_source(rows, plan.drop("source_size", "target"), n_sources)
        .select("row.*", copies.alias("copies"))
        .filter(F.col("copies") > 0)
    )
