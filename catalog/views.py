"""Message tables derived from the driver tables. ``SQL`` holds the same views for other engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from msgloom.sources.tables import spread as deal

# Filter and keywords used by the queries: words that occur in the tables.
SETTING = {"keep_keywords": ["license", "TOKEN", "逾期"], "keywords_to_remove": ["tionre", "ungge", "queue?s", "eaha"]}
KEYWORDS = {"loan": ["还款", "the ", "tion"], "risk": ["逾期", "token", "555"], "promo": ["优惠", "活动", "mail", "und "]}
AS_OF = "2024-02-01 00:00:00"
STOPWORDS = ["the", "of", "and", "to", "la", "que", "der", "die", "und"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, key: str) -> DataFrame:
    """The given tables are single files, so their rows are dealt over the shuffle partitions."""
    return deal(scan, key, int(scan.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def one_line(text):
    return F.translate(text, "\n\r", "  ")


def events_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a message header, without its text."""
    e = table(spark, sf_dir, "events")
    user = F.concat((F.lit(130) + F.col("user_id") % 10).cast("string"), F.lpad(F.col("user_id").cast("string"), 8, "0"))
    sign = F.concat(F.lit("【"), F.col("event_type"), F.lit("-"), (F.col("event_id") % 7).cast("string"), F.lit("】"))
    return e.select(
        F.col("event_id").alias("row_no"),
        user.alias("id"),
        F.when(F.col("event_id") % 17 != 0, sign).alias("sign"),
        F.when(F.col("event_id") % 101 != 0, F.col("ts")).alias("ts"),
        F.when(F.col("user_id") % 3 == 0, 1).otherwise(0).alias("label"),
        "event_type",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per event; the texts are whole documents, dressed up by event type."""
    documents = table(spark, sf_dir, "documents")
    n = documents.count()
    texts = spread(documents, "doc_id").select("doc_id", one_line("text").alias("text"))
    headers = spread(events_with_id(spark, sf_dir).withColumn("doc_id", F.col("row_no") % n), "row_no")
    rows = headers.join(texts, "doc_id")
    kind, no, text = F.col("event_type"), F.col("row_no").cast("string"), F.col("text")
    amount = (F.col("row_no") % 5000).cast("string")
    message = (
        F.when(kind == "signup", F.concat(F.lit("Verification Code "), no, F.lit(": "), text))
        .when(kind == "purchase", F.concat(text, F.lit(" ￥"), amount, F.lit("元 https://pay.example/"), no))
        .when(kind == "error", F.concat(F.lit("逾期还款，"), text, F.lit(" 3.5万 "), amount))
        .when(kind == "click", F.concat(text, F.lit("。优惠活动！ "), amount, F.lit(" usd")))
        .otherwise(text)
    )
    return rows.select("row_no", "id", message.alias("message"), "sign", "ts", "label")


def ordered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).withColumnRenamed("row_no", "ord")


def ordered_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures and times without the texts, for work that reads no text."""
    return events_with_id(spark, sf_dir).drop("event_type").withColumnRenamed("row_no", "ord")


def source_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a message of its source."""
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("source").alias("id"), F.col("doc_id").alias("ord"), one_line("text").alias("message")
    )


def message_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with one of the vectors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    n = vectors.count()
    headers = spread(events_with_id(spark, sf_dir), "row_no").select("id", (F.col("row_no") % n).alias("vec_id"))
    return headers.join(vectors, "vec_id").select("id", "embedding")


def md5_number(text, start: int = 1):
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("bigint")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score with many ties per event, loosely tied to the label."""
    headers = events_with_id(spark, sf_dir)
    noise = md5_number(F.col("row_no").cast("string")) % 800
    return headers.select(
        F.col("row_no").cast("string").alias("id"),
        ((noise + F.col("label") * 100 + 20) / F.lit(1000.0)).alias("score"),
        "label",
    )


EVENTS_SQL = """
headers as (
  select event_id as row_no,
         concat(cast(130 + user_id % 10 as varchar), lpad(cast(user_id as varchar), 8, '0')) as id,
         case when event_id % 17 <> 0
              then concat('【', event_type, '-', cast(event_id % 7 as varchar), '】') end as sign,
         case when event_id % 101 <> 0 then ts end as ts,
         case when user_id % 3 = 0 then 1 else 0 end as label,
         event_type
  from events
)"""

MESSAGES_SQL = (
    EVENTS_SQL
    + """,
texts as (
  select doc_id, replace(replace(text, chr(10), ' '), chr(13), ' ') as text from documents
),
messages as (
  select h.row_no, h.id, h.sign, h.ts, h.label,
         case h.event_type
           when 'signup' then concat('Verification Code ', h.row_no, ': ', t.text)
           when 'purchase' then concat(t.text, ' ￥', h.row_no % 5000, '元 https://pay.example/', h.row_no)
           when 'error' then concat('逾期还款，', t.text, ' 3.5万 ', h.row_no % 5000)
           when 'click' then concat(t.text, '。优惠活动！ ', h.row_no % 5000, ' usd')
           else t.text end as message
  from headers h join texts t on t.doc_id = h.row_no % (select count(*) from documents)
)"""
)

SOURCE_TEXTS_SQL = """
source_texts as (
  select source as id, doc_id as ord, replace(replace(text, chr(10), ' '), chr(13), ' ') as message from documents
)"""

VECTORS_SQL = (
    EVENTS_SQL
    + """,
message_vectors as (
  select h.id, v.embedding
  from headers h join embeddings v on v.vec_id = h.row_no % (select count(*) from embeddings)
)"""
)

SCORES_SQL = (
    EVENTS_SQL
    + """,
scores as (
  select cast(row_no as varchar) as id, label,
         (('0x' || substr(md5(cast(row_no as varchar)), 1, 8))::bigint % 800 + label * 100 + 20) / 1000.0::double as score
  from headers
)"""
)
