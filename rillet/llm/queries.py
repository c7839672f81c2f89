"""One query per operator over its whole table, and its answer in DuckDB SQL where SQL can give it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rillet.llm.arc import archive
from rillet.llm.common import shared_folder
from rillet.llm.conversations import conversation_report, damaged
from rillet.llm.decontaminate import leaks
from rillet.llm.exact_dedup import exact_groups
from rillet.llm.html_text import extract
from rillet.llm.jaccard_join import similar_classes
from rillet.llm.langid import identify, learn, training_texts
from rillet.llm.mixing import mix_documents
from rillet.llm.near_dedup import near_groups
from rillet.llm.periodic_runs import best_run, periodic_runs, with_planted_runs
from rillet.llm.pii import personal_data
from rillet.llm.suffix_dedup import without_repeats
from rillet.llm.token_counts import token_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT >> 24 AS place
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
    (source_size * 3)::DOUBLE AS most
  FROM sources),
filled AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS budget,
    sum(most) OVER (ORDER BY most / weight) + most / weight
      * (sum(weight) OVER () - sum(weight) OVER (ORDER BY most / weight)) AS filled
  FROM ranked),
level AS (
  SELECT *, filled <= budget AS stops,
    sum(CASE WHEN filled <= budget THEN most ELSE 0 END) OVER () AS given,
    sum(CASE WHEN filled <= budget THEN 0 ELSE weight END) OVER () AS rest
  FROM filled),
targets AS (
  SELECT source, source_size, CASE WHEN stops THEN most ELSE weight * ((budget - given) / rest) END AS target FROM level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole,
    target - whole * source_size AS need
  FROM targets),
groups AS (
  SELECT s.source, place, sum(s.size)::BIGINT AS size,
    (sum(sum(s.size)) OVER (PARTITION BY s.source ORDER BY place))::BIGINT AS upto
  FROM sized s GROUP BY s.source, place)
SELECT s.doc_id, s.size, p.source_size, p.target,
  (s.size * (p.whole + CASE WHEN g.upto <= p.need THEN 1
    WHEN g.upto - g.size <= p.need AND g.upto - p.need < p.need - (g.upto - g.size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN groups g ON s.source IS NOT DISTINCT FROM g.source AND s.place = g.place
JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
"""


@query(_MIX_SQL)
def op1_mixing(spark, sf_dir):
    """All documents mixed to the weights 5, 2, 1 of their sources."""
    return mix_documents(table(spark, sf_dir, "documents")).drop("source", "copies")


@query(
    """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
)
def op2_exact_dedup(spark, sf_dir):
    """Equal documents; of each group the largest id stays."""
    return exact_groups(table(spark, sf_dir, "documents"), keep="largest")


@query()
def op7_language_id(spark, sf_dir):
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(training_texts(docs)))


@query()
def op8_near_dedup(spark, sf_dir):
    """Groups of documents whose shingle sets are similar by 75 percent or more."""
    return near_groups(table(spark, sf_dir, "documents"))


@query()
def op3_decontaminate(spark, sf_dir):
    """Documents that hold benchmark items, with the items."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    """
WITH t AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT *, list_aggregate(list_transform(range(40), lambda i:
    lpad(bin(strpos('0123456789abcdef', substr(hex, (i + 1)::BIGINT, 1)) - 1), 4, '0')), 'string_agg', '') AS b FROM t)
SELECT page_id, octet_length(payload) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (list_sum(list_transform(range(5), lambda j: substr(b, (i * 5 + j + 1)::BIGINT, 1)::INT * (16 >> j::INT))) + 1)::BIGINT, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = min(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> min(page_id) OVER g THEN min(page_id) OVER g END AS refers_to
FROM bits WINDOW g AS (PARTITION BY payload)
"""
)
def op4_arc(spark, sf_dir):
    """All pages written as ARC, converted to WARC and read back."""
    return archive(table(spark, sf_dir, "pages"), shared_folder(spark)).drop("url", "date")


@query()
def op10_token_counts(spark, sf_dir):
    """Tokens of every document, by line."""
    return token_counts(table(spark, sf_dir, "documents"))


@query()
def op9_html_text(spark, sf_dir):
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))


@query()
def op5_pii(spark, sf_dir):
    """Personal data in every document."""
    return personal_data(table(spark, sf_dir, "documents"))


@query()
def op6_suffix_dedup(spark, sf_dir):
    """Every document without the strings of 400 bytes that occur elsewhere."""
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query()
def op11_jaccard_join(spark, sf_dir):
    """Classes of documents whose sets of three words are similar by 90 percent or more."""
    return similar_classes(table(spark, sf_dir, "documents"))


@query()
def op12_periodic_runs(spark, sf_dir):
    """Runs of periodic words in every document, a tenth of them made periodic at the end."""
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))).withColumn("best", best_run("runs"))
    return found.selectExpr(
        "doc_id",
        "CAST(size(runs) AS BIGINT) AS n_runs",
        "best.start AS start",
        "best.length AS length",
        "best.period AS period",
        "1000 * best.length DIV best.period AS exponent_milli",
        "sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), ''), 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


@query()
def op13_conversations(spark, sf_dir):
    """Every conversation, damaged and repaired."""
    rows = table(spark, sf_dir, "conversations")
    return conversation_report(rows, damaged(rows))
