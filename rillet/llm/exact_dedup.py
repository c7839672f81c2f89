"""Exact duplicates: group by a 128-bit content hash and compare the texts inside the groups."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.common import checkpointed, group_totals, lower_ascii, salts


def normalised(text: Column) -> Column:
    """What is compared: A-Z in lower case, null as empty."""
    return lower_ascii(F.coalesce(text, F.lit("")))


def _hashed(docs: DataFrame, doc_id: str, text: str, hash_bits: int) -> DataFrame:
    """(doc_id, text, sha, key); the key is as many leading bits of the SHA-256."""
    return docs.select(F.col(doc_id).alias("doc_id"), normalised(F.col(text)).alias("text")).withColumn(
        "sha", F.sha2("text", 256)
    ).withColumn("key", F.substring("sha", 1, hash_bits // 4))


def _texts_of(docs: DataFrame, groups: DataFrame, parts: int) -> DataFrame:
    """The rows of ``docs`` whose (key, salt) ``groups`` holds, with their texts."""
    rows = docs.withColumn("salt", _salt(parts))
    return rows.join(groups.select("key", "salt"), ["key", "salt"], "left_semi")


def _salt(parts: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(parts)).cast("int")


def exact_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest", hash_bits: int = 128
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  Of equal texts the
    row with the smallest (or largest) id stays; a null id counts as the smallest.  Of several rows
    with that id one stays.  Other columns are not read; an empty table gives an empty result.

    Small rows of id and hash find the groups.  Only texts of groups with several rows are looked at
    again, and grouped by hash and text; a hash that stands for several texts is then split by text.
    Groups are counted in parts (``group_totals``), so a hash that a third of all rows share is not
    handled by one task.
    """
    best = {"smallest": "min", "largest": "max"}[keep]
    parts = salts(docs.sparkSession)
    hashed = _hashed(docs, doc_id, text, hash_bits)
    slim = checkpointed(
        hashed.select(
            F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("id"),
            "doc_id", "sha", "key", _salt(parts).alias("salt"),
        )
    )
    count = {"group_size": ("count", "key"), "best": (best, "id")}
    totals = group_totals(slim, "key", "salt", count)
    members = _texts_of(hashed, totals.filter("group_size > 1"), parts)
    texts = members.groupBy("key", "text").count()
    clashes = checkpointed(texts.groupBy("key").count().filter("count > 1").select("key"))
    if clashes.isEmpty():
        grouped = slim.join(totals, ["key", "salt"])
    else:
        # Equal hash, unequal text: the text itself, by way of its SHA-256, becomes part of the key.
        grouped = _split_by_text(slim, hashed, clashes, count)
    return _result(grouped, keep)


def _split_by_text(slim: DataFrame, hashed: DataFrame, clashes: DataFrame, count: dict) -> DataFrame:
    """Groups of (key, sha) wherever a key stands for several texts."""
    split = slim.join(clashes.withColumn("clash", F.lit(True)), "key", "left").withColumn(
        "key", F.when(F.col("clash"), F.concat("key", F.lit("/"), "sha")).otherwise(F.col("key"))
    ).drop("clash")
    return split.join(group_totals(split, "key", "salt", count), ["key", "salt"])


def _result(grouped: DataFrame, keep: str) -> DataFrame:
    return grouped.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("id.row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; rules as in ``exact_groups``."""
    groups = exact_groups(docs, keep=keep).filter("kept").select(
        F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", normalised(F.col("text")).alias("text"))
    rows = rows.select("row", "doc_id", F.sha2("text", 256).alias("sha256"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("sha256") == F.col("sha"))
    stay = rows.join(groups, same, "left_semi")
    if _repeats(docs):
        stay = stay.dropDuplicates(["doc_id", "sha256"])
    return stay.select("row.*")


def _repeats(docs: DataFrame) -> bool:
    """Whether an id occurs on several rows."""
    return not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()
