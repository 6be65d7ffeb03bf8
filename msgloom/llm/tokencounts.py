"""Token counts kept up to date by deltas.

A ledger in the shared folder has one directory per batch, with one signed row per changed document and
tokenizer version. A batch says what its documents count now (or that they are gone); the rows it
adds are the difference to what earlier batches left. Beside the ledger lie the batch's own totals by source,
language and tokenizer version: adding up those small tables gives the rollup.

Committing is idempotent: a batch's rows depend on its input and on smaller batch numbers only, and
its directory is replaced whole, its totals last. A retried or repeated commit therefore changes nothing. The input of every batch
is kept, so a batch that is committed late, or again with other rows, has the batches after it worked out anew. A
batch without totals (a commit or a replay that was cut off) ends what the rollup counts: it and all later batches
wait until it has been committed again.

Edge cases: null source and language are groups of their own. A null id is one document. Of rows that name
the same document and tokenizer twice in one batch, the one with the most tokens counts; a deletion wins
over all. Deleting an unknown document and revising a count to itself add nothing. Groups whose
documents are all gone leave the rollup. Empty batches may be committed.
"""

from __future__ import annotations

from itertools import takewhile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import Staging
from .rows import word_count

KEYS = ["source", "lang", "tokenizer"]
CHANGE = ["doc_id", *KEYS, "n_tokens"]  # n_tokens null: the document is gone
LEDGER_SCHEMA = "doc_id long, source string, lang string, tokenizer string, docs long, n_tokens long"
CHANGES_SCHEMA = "doc_id long, tokenizer string, new struct<n_tokens: long, source: string, lang: string>, gone boolean"
TOTALS_SCHEMA = "source string, lang string, tokenizer string, docs long, n_tokens long"


class TokenLedger:
    """Batches below ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, kind: str, batch: int) -> str:
        return f"{self.path}/{kind}/batch={batch:010d}"

    def _batches(self, kind: str) -> list[int]:
        """Numbers of the batches that are written whole."""
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        path = context._jvm.org.apache.hadoop.fs.Path
        found = [s.getPath() for s in files.listStatus(folder)]
        return sorted(int(p.getName().partition("=")[2]) for p in found if files.exists(path(p, "_SUCCESS")))

    def committed(self) -> list[int]:
        """Numbers of the batches that count: the complete ones before the first that is not."""
        done = set(self._batches("totals"))
        known = sorted(done | set(self._batches("changes")))
        return list(takewhile(done.__contains__, known))

    def _read(self, kind: str, batches: list[int], schema: str) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(self._folder(kind, b) for b in batches))

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Apply ``changes`` (columns CHANGE) as batch number ``batch``, and later batches again if that changes what they found.

        Rows of one document meet through a shuffle on the document and tokenizer; no group is larger than
        the document's own history.
        """
        waiting = [b for b in self._batches("changes") if b < batch and b not in self.committed()]
        if waiting:
            raise ValueError(f"batch {waiting[0]} was cut off; commit it again first")
        gone = F.max(F.col("n_tokens").isNull())
        now = changes.groupBy("doc_id", "tokenizer").agg(F.max(F.struct("n_tokens", "source", "lang")).alias("new"), gone.alias("gone"))
        before = self._digest(batch)
        self._drop("totals", batch)  # from here until the new totals are there, the batch does not count
        now.write.mode("overwrite").parquet(self._folder("changes", batch))
        later = [b for b in self._batches("changes") if b > batch]
        self._apply(batch, publish=False)
        if self._digest(batch) != before:
            for stale in later:
                self._drop("totals", stale)
            self._publish(batch)
            for stale in later:
                self._apply(stale)
        else:
            self._publish(batch)

    def _digest(self, batch: int) -> tuple | None:
        """What the ledger has of a batch, in any order; None if nothing."""
        if batch not in self._batches("ledger"):
            return None
        rows = self._read("ledger", [batch], LEDGER_SCHEMA)
        place = F.array(*(F.col(c).isNull() for c in rows.columns))  # a hash passes over nulls
        hashes = [F.bit_xor(F.xxhash64(F.lit(i), place, *rows.columns)) for i in range(2)]
        return tuple(rows.agg(F.count("*"), F.sum("n_tokens"), *hashes).first())

    def _publish(self, batch: int) -> None:
        totals = self._read("ledger", [batch], LEDGER_SCHEMA).groupBy(*KEYS)
        totals = totals.agg(F.sum("docs").alias("docs"), F.sum("n_tokens").alias("n_tokens"))
        totals.write.mode("overwrite").parquet(self._folder("totals", batch))

    def _apply(self, batch: int, publish: bool = True) -> None:
        """Work out a batch's signed rows from its changes and the ledgers before it."""
        earlier = [b for b in self.committed() if b < batch]
        before = self._read("ledger", earlier, LEDGER_SCHEMA)
        now = self._read("changes", [batch], CHANGES_SCHEMA)
        known = before.groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("n_tokens").alias("n_tokens"))
        known = known.where("docs <> 0").select(
            F.col("doc_id").alias("known_id"), F.col("tokenizer").alias("known_tokenizer"), F.struct("source", "lang", "n_tokens").alias("old")
        )
        both = now.join(
            known,
            F.col("doc_id").eqNullSafe(F.col("known_id")) & F.col("tokenizer").eqNullSafe(F.col("known_tokenizer")),
            "left",
        )
        signed = F.array(
            F.struct("old.source", "old.lang", (-F.when(F.col("old").isNotNull(), 1)).cast("long").alias("docs"), (-F.col("old.n_tokens")).alias("n_tokens")),
            F.struct("new.source", "new.lang", F.when(~F.col("gone"), 1).cast("long").alias("docs"), F.col("new.n_tokens").alias("n_tokens")),
        )
        rows = both.select("doc_id", "tokenizer", F.explode(signed).alias("s")).where("s.docs is not null")
        netted = (
            rows.select("doc_id", "s.source", "s.lang", "tokenizer", "s.docs", "s.n_tokens")
            .groupBy("doc_id", *KEYS)
            .agg(F.sum("docs").alias("docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("docs <> 0 or n_tokens <> 0")
        )
        netted.write.mode("overwrite").parquet(self._folder("ledger", batch))
        if publish:
            self._publish(batch)

    def _drop(self, kind: str, batch: int) -> None:
        context = self.spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(self._folder(kind, batch))
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)

    def rollup(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all complete batches."""
        totals = self._read("totals", self.committed(), TOTALS_SCHEMA)
        summed = totals.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0")


def counts_of(docs: DataFrame, versions: dict) -> DataFrame:
    """Changes that set every document to its counts; ``versions`` names a count column per tokenizer."""
    rows = F.array(*(F.struct(F.lit(name).alias("tokenizer"), column.cast("long").alias("n_tokens")) for name, column in versions.items()))
    return docs.select("doc_id", "source", "lang", F.explode(rows).alias("c")).select("doc_id", "source", "lang", "c.*").select(*CHANGE)


def op8_token_counts(spark, sf_dir):
    """Per source, language and tokenizer version: n_docs, n_tokens.

    Batch 1 inserts every document with an estimate of its words from n_chars and an exact
    count of letter and digit runs, batch 2 revises the estimates to exact counts over the whole texts, batch 3
    deletes texts that occur again under a larger id, and batch 2 is committed once more.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ledger = TokenLedger(spark, f"{Staging(spark).path}/token-ledger")
    runs = F.coalesce(F.regexp_count("text", F.lit("[A-Za-z0-9]+")), F.lit(0))
    ledger.commit(1, counts_of(docs, {"words-1": F.floor(F.coalesce("n_chars", F.lit(0)) / 6), "runs-1": runs}))
    exact = counts_of(docs, {"words-1": word_count(F.col("text"))})
    ledger.commit(2, exact)
    text = F.coalesce("text", F.lit(""))
    hashed = docs.select("doc_id", F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"))
    # copies of one text combine before the shuffle; the join back is split where one text is frequent
    newest = Staging(spark).write(hashed.groupBy("h", "g").agg(F.max("doc_id").alias("last"), F.count("*").alias("n")).where("n > 1"), "copies")
    old = hashed.join(newest, ["h", "g"]).where("doc_id < last").select("doc_id")
    gone = F.explode(F.array(F.lit("words-1"), F.lit("runs-1"))).alias("tokenizer")
    missing = F.lit(None).cast("string")
    ledger.commit(3, old.select("doc_id", missing.alias("source"), missing.alias("lang"), gone, F.lit(None).cast("long").alias("n_tokens")))
    ledger.commit(2, exact)
    return ledger.rollup()


SQL = r"""
with last as (select coalesce(text, '') as body, max(doc_id) as keep from documents group by 1),
gone as (select distinct d.doc_id from documents d join last l on coalesce(d.text, '') = l.body and d.doc_id < l.keep),
kept as (select * from documents d where not exists (select 1 from gone g where g.doc_id = d.doc_id)),
each as (
  select doc_id, source, lang, 'words-1' as tokenizer, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as n from kept
  union all
  select doc_id, source, lang, 'runs-1', len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+')) from kept
), counted as (
  select source, lang, tokenizer, n from each qualify row_number() over (partition by doc_id, tokenizer order by n desc, source desc, lang desc) = 1
)
select source, lang, tokenizer, count(*) as n_docs, sum(n)::bigint as n_tokens from counted group by all
"""
