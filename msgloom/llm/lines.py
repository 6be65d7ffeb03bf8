"""Line dedup: lines that many documents hold stay in one of them only.

Lines travel as two 64-bit hashes of their key, never as text. The hashes are range-partitioned together
with the document, so a key that stands in a third of all documents is spread over many
partitions; inside one the rows lie in the order (hash, document descending, position), and a running
window marks the first occurrence in each document. Counts and keepers of the keys come from those
marks, combined before the shuffle. The result is a bitmap of dropped lines per document; texts
meet it in one join.

Edge cases: a null or empty text is one empty line. Rows with the same id count as one document,
null ids as one more, smaller than every other. Equal lines inside one document share their fate.
Rows of the same id and the same text get the same bitmap. An empty table gives an empty result.
A document all of whose lines go stays with an empty text; where nothing goes, the text (also null) stays as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .rows import WHITE, ascii_lower, keyed


def keep_bitmaps(
    docs: DataFrame,
    staging: Staging,
    min_chars: int = 40,
    min_docs: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows (doc, th, tg, dropped, n_dropped) for the documents that lose lines.

    A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents lose their lines except in the
    largest id. ``dropped`` maps a line number divided by 64 to 64 bits, set where the line goes; missing
    words keep all their lines.
    """
    key = ascii_lower(F.btrim("line", F.lit(WHITE)))
    lines = (
        keyed(docs, id_col, text_col)
        .select("doc", "th", "tg", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .where(F.char_length("line") >= min_chars)
        .select("doc", "th", "tg", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"), "doc", "th", "tg", "pos")
    )
    in_document = Window.partitionBy("h", "g", "doc").orderBy("pos")
    marked = staging.write(
        lines.repartitionByRange("h", "g", F.desc("doc")).withColumn("first", F.row_number().over(in_document) == 1),
        "lines",
    )
    frequent = staging.write(
        marked.where("first")
        .groupBy("h", "g")
        .agg(F.count("*").alias("docs"), F.max("doc").alias("keeper"))
        .where(F.col("docs") >= min_docs)
        .drop("docs"),
        "frequent-lines",
    )
    gone = marked.join(frequent, ["h", "g"]).where(F.col("doc") < F.col("keeper"))
    bit = F.expr("shiftleft(1L, pos % 64)")
    return (
        gone.groupBy("doc", "th", "tg", F.expr("cast(pos div 64 as int)").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy("doc", "th", "tg")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
            F.sum(F.bit_count("bits")).alias("n_dropped"),
        )
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` with all columns of ``docs``, and beside it ``kept`` (the text without the dropped
    lines, null only for a null text), ``n_lines`` and ``n_dropped``."""
    joined = keyed(docs, id_col, text_col).join(bitmaps, ["doc", "th", "tg"], "left")
    words = joined.withColumn("lines", F.split("text", "\n", -1)).withColumn(
        "bits", F.expr("transform(sequence(0L, (size(lines) - 1) div 64), w -> coalesce(dropped[cast(w as int)], 0L))")
    )
    kept = F.expr(r"array_join(filter(lines, (line, i) -> getbit(bits[cast(i div 64 as int)], i % 64) = 0), '\n')")
    return words.select(
        "row",
        F.when(F.col("dropped").isNull(), F.col(f"row.{text_col}")).otherwise(kept).alias("kept"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, staging: Staging, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """``docs`` with the same columns and the dropped lines gone from the text."""
    scratch = Staging(docs.sparkSession, staging.path)
    bitmaps = staging.write(keep_bitmaps(docs, scratch, id_col=id_col, text_col=text_col, **rule), "bitmaps")
    scratch.drop()
    staging.release()
    applied = apply_bitmaps(docs, bitmaps, id_col, text_col)
    return applied.select(*(F.col("kept").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def op1_line_dedup(spark, sf_dir):
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    applied = apply_bitmaps(docs, keep_bitmaps(docs, Staging(spark)))
    digest = F.sha2(F.coalesce("kept", F.lit("")), 256)
    return applied.select("row.doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents
), keyed as (
  select doc_id, line, pos,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
), frequent as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5
), judged as (
  select k.*, f.key is not null and k.doc_id <> f.keeper as gone from keyed k left join frequent f using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""
