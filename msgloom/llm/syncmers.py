"""Document fingerprints from closed syncmers.

A text is read as symbols: runs of ASCII letters and digits (A-Z lower-cased), and every other code point beyond ASCII by itself, so
that scripts without blanks are read, too. A run of ``k`` symbols is an anchor if the smallest of its inner runs of ``s``
symbols stands at its start or at its end (ties included), small by a number made of their CRC-32. Whether a run is an anchor
depends on the run alone, so a passage has the same anchors wherever it stands, and one anchor follows another after at most
k - s places. A fingerprint writes down the anchors in order: one hexadecimal digit for the distance to the one before (the first:
to the start) and four for the run itself. A unit of comparison is an anchor with its predecessor and the distance between
them, so units agree only where two anchors lie at the same places relative to each other; likeness is the Dice
coefficient of the sets of units.

All of it is column expressions, linear in the text; minima of runs are found by doubling the length of the runs.

Edge cases: a null text is an empty one, with the empty fingerprint. A text without an anchor, as those of fewer than ``k``
symbols are, has "s" and 16 digits of its MD5. Equal fingerprints are alike by 1, and empty ones and those without anchors are unlike all others. Repeated
passages count once in the likeness. Rows that repeat an id follow each other in the order of their texts' hashes, null ids
follow all others; the document after the last one is the first, so a single document follows itself. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import Staging
from .rows import ascii_lower

K, S = 5, 2
GROUPS = 4  # runs of neighbouring documents per shuffle partition
SAMPLE = 20  # keys per run that the borders are chosen from
PRIME = 65_521
LARGE_PRIME = 4_294_967_291
SYMBOL = r"[0-9a-z]+|[^\x00-\x7F]"
KEY = ["k_null", "k_id", "k_text"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shifted(values: Column, by: int, with_: Callable[[Column, Column], Column]) -> Column:
    """``with_`` of every value and the one ``by`` places further on; ``values`` is a name or lambda variable."""
    ahead = F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))
    return F.zip_with(F.slice(values, 1, F.greatest(F.size(values) - by, F.lit(0))), ahead, with_)


def _inner_numbers(symbols: Column, s: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of the numbers that all runs of ``s`` symbols are ordered by."""

    def further(first: Column, numbers: Column, length: int) -> Column:
        if length == s:
            return body(numbers)
        ahead = F.slice(first, length + 1, F.greatest(F.size(first) - length, F.lit(0)))
        own = F.slice(numbers, 1, F.size(ahead))
        return _let(F.zip_with(own, ahead, lambda x, y: (x * 31 + y) % LARGE_PRIME), lambda longer: further(first, longer, length + 1))

    return _let(F.transform(symbols, lambda symbol: F.crc32(symbol.cast("binary"))), lambda first: further(first, first, 1))


def _least_of_each(values: Column, width: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of the minima of all runs of ``width`` values."""

    def further(least: Column, length: int) -> Column:
        if length == width:
            return body(least)
        by = min(length, width - length)
        return _let(_shifted(least, by, lambda x, y: F.least(x, y)), lambda m: further(m, length + by))

    return further(values, 1)


def anchors_of(text: Column, k: int = K, s: int = S) -> Column:
    """All anchors of a text in order, as place * 65536 + number of the run."""
    last = k - s

    def anchors(h: Column) -> Column:
        def judged(least: Column, i: Column) -> Column:
            parts = [F.get(h, i + d) for d in sorted({*range(0, last, s), last})]
            run = reduce(lambda total, part: (total * 31 + part) % PRIME, parts, F.lit(0).cast("bigint"))
            return F.when(F.least(parts[0], parts[-1]) <= least, i.cast("bigint") * 65536 + run)

        return _least_of_each(h, last + 1, lambda least: F.filter(F.transform(least, judged), lambda a: a.isNotNull()))

    return _inner_numbers(F.regexp_extract_all(ascii_lower(text), F.lit(SYMBOL), F.lit(0)), s, anchors)


def fingerprint(text: Column, k: int = K, s: int = S) -> Column:
    """Fingerprint of a text; k - s may be 15 at most, as a distance is one digit."""
    if not 0 < s < k <= s + 15:
        raise ValueError("k - s must lie between 1 and 15")
    text = F.coalesce(text, F.lit(""))

    def written(anchors: Column) -> Column:
        def digits(anchor: Column, i: Column) -> Column:
            before = F.coalesce(F.get(anchors, i - 1), F.lit(0).cast("bigint"))
            return F.lpad(F.hex(anchor - before + before % 65536), 5, "0")

        return F.array_join(F.transform(anchors, digits), "")

    joined = _let(anchors_of(text, k, s), written)
    without = F.concat(F.lit("s"), F.left(F.md5(text.cast("binary")), F.lit(16)))
    return F.when(text == "", F.lit("")).otherwise(_let(joined, lambda found: F.when(found == "", without).otherwise(found)))


def units(print_: Column) -> Column:
    """The distinct units of a fingerprint: number of the anchor before (dashes for none), distance, number."""
    return F.array_distinct(F.regexp_extract_all(F.concat(F.lit("----"), print_), F.lit("(?=(.{9})).{5}"), F.lit(1)))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, from 0 to 1."""

    def dice(x: Column, y: Column) -> Column:
        return F.size(F.array_intersect(x, y)) * 2.0 / (F.size(x) + F.size(y))

    without = (a == "") | (b == "") | a.startswith("s") | b.startswith("s")
    both = _let(units(a), lambda x: _let(units(b), lambda y: dice(x, y)))
    return F.when(a == b, 1.0).when(without, 0.0).otherwise(both)


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row``, ``text``, the key by which ids descend and null ids come last, equal ids going by text, and a number that
    tells equal rows apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.col(id_col).cast("bigint")
    return docs.select(
        F.struct("*").alias("row"),
        text.alias("text"),
        number.isNull().cast("bigint").alias("k_null"),
        F.coalesce(F.bitwise_not(number), F.lit(0)).alias("k_id"),
        F.xxhash64(text).alias("k_text"),
        F.xxhash64(F.monotonically_increasing_id()).alias("salt"),
    )


def _borders(keys: DataFrame, groups: int) -> list[tuple[tuple, int]]:
    """First keys of runs of neighbours, and over how many runs rows with exactly that key are dealt.

    They come from a sample of about ``SAMPLE`` keys per run; where they lie changes no result.
    """
    share = min(1.0, SAMPLE * groups / max(keys.count(), 1))
    drawn = keys.where(F.pmod("salt", F.lit(1 << 30)) < int(share * (1 << 30))).select(*KEY).collect()
    found = sorted(tuple(r) for r in drawn)
    return sorted(Counter(found[i * len(found) // groups] for i in range(1, groups)).items()) if found else []


def _place(borders: list[tuple[tuple, int]]) -> tuple[Column, Column]:
    """Run of a key, and its part of that run."""
    if not borders:
        return F.lit(0), F.lit(0)
    key = F.struct(*KEY)
    literal = [F.struct(*(F.lit(x).cast("bigint").alias(c) for c, x in zip(KEY, border))) for border, _ in borders]
    run = F.size(F.filter(F.array(*literal), lambda border: border <= key))
    parts = F.get(F.array(F.lit(1), *(F.lit(parts) for _, parts in borders)), run)
    first = F.get(F.array(literal[0], *literal), run) == key
    part = F.when(first, F.pmod("salt", parts)).otherwise(parts - 1)
    return run, part.cast("int")


def with_next(docs: DataFrame, staging: Staging, id_col: str = "doc_id", text_col: str = "text", groups: int | None = None, **shape) -> DataFrame:
    """``row``, text, fingerprint, and next_text and next_fingerprint of the document that follows by descending id.

    Documents meet in runs of neighbours, a window each. The first document of a run also visits the run before (that of
    the first run the last one), so only one row per run crosses a border, and texts are shuffled once. A row that is repeated
    more often than a run is long has several runs to itself, each of which it also visits.
    """
    spark = docs.sparkSession
    ordered = _in_order(docs, id_col, text_col)
    keys = staging.write(ordered.select(*KEY, "salt"), "order")
    borders = _borders(keys, groups or GROUPS * int(spark.conf.get("spark.sql.shuffle.partitions")))
    run, part = _place(borders)
    heads = keys.groupBy(run.alias("run")).agg(F.min(F.struct(*KEY)).alias("key")).collect()  # one row per run
    heads = sorted((r["run"], tuple(r["key"])) for r in heads)
    parts = {number: parts for number, (_, parts) in enumerate(borders, 1)}
    visits = [(r, p, *heads[i][1]) for i, (r, _) in enumerate(heads) for p in range(parts.get(r, 1) - 1)]
    visits += [(r, parts.get(r, 1) - 1, *heads[(i + 1) % len(heads)][1]) for i, (r, _) in enumerate(heads)]
    visiting = spark.createDataFrame(visits, "run int, part int, " + ", ".join(f"{c} bigint" for c in KEY))
    # one row per run, so a bounded number of rows to broadcast; equal rows are first reduced to one
    met = ordered.join(F.broadcast(visiting.select(*KEY).distinct()), KEY).groupBy(*KEY).agg(F.first("text").alias("text"))
    nothing = F.lit(None).cast(ordered.schema["row"].dataType).alias("row")
    guests = visiting.join(met, KEY).select(nothing, "text", *KEY, "run", "part", F.lit(1).alias("late"))
    everyone = ordered.select("row", "text", *KEY, run.alias("run"), part.alias("part"), F.lit(0).alias("late")).unionByName(guests)
    # after the shuffle, as input files may be few; both windows share it and its order
    onwards = Window.partitionBy("run", "part").orderBy("late", *KEY)
    followed = everyone.withColumn("next_text", F.lead("text").over(onwards)).withColumn("fingerprint", fingerprint(F.col("text"), **shape))
    followed = followed.withColumn("next_fingerprint", F.lead("fingerprint").over(onwards))
    return followed.where("late = 0").select("row", "text", "fingerprint", "next_text", "next_fingerprint")


def edited_by_next(docs: DataFrame, staging: Staging, id_col: str = "doc_id", text_col: str = "text", **shape) -> DataFrame:
    """``row``, and beside it n_chars, fingerprint, edited, edited_fingerprint, near_edited and near_next.

    The edited text has its last third (rounded down) replaced by as many code points from the start of the next document, or all it has.
    """
    n = F.char_length("text")
    tail = F.floor(n / 3).cast("int")
    both = with_next(docs, staging, id_col, text_col, **shape).withColumn("n_chars", n.cast("bigint"))
    both = both.withColumn("edited", F.concat(F.left("text", n - tail), F.left("next_text", tail)))
    shape.pop("groups", None)
    both = both.withColumn("edited_fingerprint", fingerprint(F.col("edited"), **shape))
    return both.select(
        "row",
        "n_chars",
        "fingerprint",
        "edited",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op13_fingerprints(spark, sf_dir):
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = edited_by_next(docs, Staging(spark))
    digest = F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256")
    return found.select("row.doc_id", "n_chars", digest, "fingerprint", "edited_fingerprint", "near_edited", "near_next")


SQL = r"""
with plain as (
  select doc_id, coalesce(text, '') as text from documents
), followed as (
  select doc_id, text, coalesce(lead(text) over (order by doc_id desc), first_value(text) over (order by doc_id desc)) as next_text from plain
), edited as (
  select doc_id, text, length(text) as n, text[1:(length(text) - length(text) // 3)::bigint] || next_text[1:(length(text) // 3)::bigint] as changed, next_text
  from followed
), versions as (
  select doc_id, 'own' as version, text as t from edited union all
  select doc_id, 'changed', changed from edited
), symbols as (
  select doc_id, version, unnest(range(len(w))) as i, unnest(w) as part
  from (select doc_id, version, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z]+|[^\x00-\x7F]') as w from versions)
), crc_table as (
  select list(list_reduce(range(8), lambda c, bit: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, b) order by b) as tab
  from range(256) r(b)
), coded as (
  select part, hex(encode(part)) as x from (select distinct part from symbols)
), numbered as (
  select part, xor(list_reduce(list_transform(range(len(x) // 2), lambda j: ('0x' || substr(x, (1 + 2 * j)::bigint, 2))::bigint),
                               lambda c, byte: xor(c // 256, tab[(1 + xor(c % 256, byte))::bigint]), 4294967295::bigint), 4294967295::bigint) as c
  from coded, crc_table
), pairs as (
  select doc_id, version, i, (c * 31 + lead(c) over (partition by doc_id, version order by i)) % 4294967291 as h
  from symbols join numbered using (part)
), windows as (
  select doc_id, version, i, h, min(h) over w as least, lead(h, 2) over o as h2, lead(h, 3) over o as h3
  from pairs
  window o as (partition by doc_id, version order by i), w as (partition by doc_id, version order by i rows between current row and 3 following)
), anchors as (
  select doc_id, version, i, ((h % 65521) * 31 + h2 % 65521) * 31 + h3 % 65521 as run
  from windows where h3 is not null and (h = least or h3 = least)
), written as (
  select doc_id, version, i, printf('%04X', run % 65521) as number, printf('%X', i - coalesce(lag(i) over o, 0)) as gap, lag(run % 65521) over o as before
  from anchors window o as (partition by doc_id, version order by i)
), joined as (
  select doc_id, version, string_agg(gap || number, '' order by i) as print,
         list(distinct coalesce(printf('%04X', before), '----') || gap || number) as units
  from written group by 1, 2
), prints as (
  select v.doc_id, v.version, case when t = '' then '' else coalesce(print, 's' || md5(t)[1:16]) end as print, coalesce(units, []) as units
  from versions v left join joined using (doc_id, version)
), own as (
  select doc_id, print, units, coalesce(lead(doc_id) over o, first_value(doc_id) over o) as next_id
  from prints where version = 'own' window o as (order by doc_id desc)
), changed as (
  select doc_id, print, units from prints where version = 'changed'
)
select e.doc_id, e.n as n_chars, sha256(e.changed) as edited_sha256, o.print as fingerprint, c.print as edited_fingerprint,
       case when o.print = c.print then 1.0::double when len(o.units) = 0 or len(c.units) = 0 then 0.0
            else len(list_intersect(o.units, c.units)) * 2.0::double / (len(o.units) + len(c.units)) end as near_edited,
       case when o.print = x.print then 1.0::double when len(o.units) = 0 or len(x.units) = 0 then 0.0
            else len(list_intersect(o.units, x.units)) * 2.0::double / (len(o.units) + len(x.units)) end as near_next
from edited e join own o using (doc_id) join changed c using (doc_id) join own x on x.doc_id = o.next_id
"""
