"""Language identification by interpolated Kneser-Ney character models.

Text becomes symbols: letters in lower case, and one space for each run of anything else. Four
symbols pack into one 64-bit number, so a model is a few sorted arrays of numbers, searched by bisection. Spark
counts the four-grams of every labelled training document; the lower orders follow from the
four-grams, as Kneser-Ney takes them from distinct contexts. A document goes to the language of the lowest
cross-entropy per symbol. Its excess over what that language's own documents show under models that have not
seen them, scaled for length, decides whether it is accepted; languages with few documents lean on the others.

The model holds every four-gram of the training text and grows with it. Spark works out continuation counts,
discounts and probabilities and writes them sorted to the shared folder; the driver gets their numbers per
language and order only. Each Python worker copies them once to a file of its own without a name and maps
that, so the model need not fit in memory.

Edge cases: texts that are null or hold no letter are ``und`` with score 0 and rejected; so is
everything if nothing could be learned. Ties go to the language first in code point order. Rows are
independent, so repeated ids do no harm; a null id falls in the fold of the empty string. Texts of
any length are read whole, in slices.
"""

from __future__ import annotations

import math
import tempfile
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import Staging
from .rows import crc_fold

ORDER = 4
SYMBOL_BITS = 16
SLICE = 1 << 20  # symbols looked at together
WHOLE = -1  # the fold left out of the models of all documents
LEANING = 30  # documents that the other languages count for in a language's spread
UNDETERMINED = "und"
PREDICTION = "lang_pred string, score double, cross_entropy double, n_symbols long"


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point: letters in lower case (beyond 16 bits folded into the private
    use area, where there are no letters), 0 for all others."""
    table = np.zeros(0x110000, np.uint16)
    for point in range(0x110000):
        char = chr(point)
        if unicodedata.category(char)[0] == "L":
            low = char.lower()
            code = ord(low) if len(low) == 1 else point
            table[point] = code if code < 0x10000 else 0xE000 + code % 0x1900
    return table


def symbols(text: str) -> np.ndarray:
    """Symbols of a text between single spaces; empty if it holds no letter."""
    found = symbol_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not found.any():
        return found[:0]
    padded = np.concatenate(([0], found, [0])).astype(np.uint64)
    return padded[np.concatenate(([True], (padded[1:] != 0) | (padded[:-1] != 0)))]


def four_grams(sequence: np.ndarray) -> np.ndarray:
    """Each symbol after the leading space with the three before it; spaces stand before the text."""
    wide = np.concatenate((np.zeros(2, np.uint64), sequence))
    return wide[:-3] << np.uint64(48) | wide[1:-2] << np.uint64(32) | wide[2:-1] << np.uint64(16) | wide[3:]


class KneserNey:
    """One language: per order the known grams with their full probability, and per context the mass left to
    the next lower order."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        keys, numbers = grams[order], counts[order].astype(np.float64)
        levels = []
        for n in range(ORDER, 0, -1):
            levels.append((keys, numbers))
            shorter = keys & np.uint64((1 << SYMBOL_BITS * (n - 1)) - 1)
            keys, distinct = np.unique(shorter, return_counts=True)
            numbers = distinct.astype(np.float64)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # from order 1 up
        for n, (keys, numbers) in enumerate(reversed(levels), 1):
            once, twice = (numbers == 1).sum(), (numbers == 2).sum()
            discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
            contexts, place, types = np.unique(keys >> np.uint64(SYMBOL_BITS), return_inverse=True, return_counts=True)
            totals = np.bincount(place, numbers)
            left = discount * types / totals
            lower = self.probabilities(keys & np.uint64((1 << SYMBOL_BITS * (n - 1)) - 1), n - 1)
            full = np.maximum(numbers - discount, 0) / totals[place] + left[place] * lower
            self.levels.append((keys, full, contexts, left))

    @classmethod
    def of(cls, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> KneserNey:
        """From what was worked out before, order 1 first: sorted grams with probabilities, sorted contexts with masses."""
        model = cls.__new__(cls)
        model.levels = levels
        return model

    def probabilities(self, grams: np.ndarray, n: int = ORDER) -> np.ndarray:
        if n == 0:
            return np.full(len(grams), 1.0 / (1 << SYMBOL_BITS))
        keys, full, contexts, left = self.levels[n - 1]
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        out = full[at]
        unseen = np.flatnonzero(keys[at] != grams)
        if len(unseen):
            rest = grams[unseen]
            context = rest >> np.uint64(SYMBOL_BITS)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            mass = np.where(contexts[at] == context, left[at], 1.0)
            out[unseen] = mass * self.probabilities(rest & np.uint64((1 << SYMBOL_BITS * (n - 1)) - 1), n - 1)
        return out


Models = list[tuple[str, KneserNey]]


def _mapped(files: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The two columns of Parquet files of sorted numbers, in the order of the files."""
    opened = []
    for name in files:
        system, path = FileSystem.from_uri(name)
        opened.append((system, path, pq.read_metadata(path, filesystem=system).num_rows))
    total = sum(rows for _, _, rows in opened)
    if not total:
        return np.zeros(0, np.uint64), np.zeros(0)
    with tempfile.TemporaryFile() as space:
        both = np.memmap(space, np.int64, "w+", shape=(2, total))
    keys, values = np.asarray(both[0]).view(np.uint64), np.asarray(both[1]).view(np.float64)
    at = 0
    for system, path, _ in opened:
        with system.open_input_file(path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=["gram", "value"]):
                keys[at : at + len(batch)] = batch.column("gram").to_numpy().view(np.uint64)
                values[at : at + len(batch)] = batch.column("value").to_numpy()
                at += len(batch)
    return keys, values


@dataclass(frozen=True)
class Stored:
    """Where the models lie: sorted files of grams and contexts, and (fold left out, language, order, grams, contexts) in their
    order."""

    grams: tuple[str, ...] = ()
    contexts: tuple[str, ...] = ()
    sizes: tuple[tuple[int, str, int, int, int], ...] = ()

    def models(self, without: int = WHOLE) -> Models:
        return _loaded(self).get(without, [])


@lru_cache(maxsize=1)
def _loaded(stored: Stored) -> dict[int, Models]:
    keys, full = _mapped(stored.grams)
    contexts, left = _mapped(stored.contexts)
    found: dict[int, dict[str, list]] = {}
    at = by = 0
    for without, lang, _, grams, heads in stored.sizes:
        level = keys[at : at + grams], full[at : at + grams], contexts[by : by + heads], left[by : by + heads]
        found.setdefault(without, {}).setdefault(lang, []).append(level)
        at, by = at + grams, by + heads
    return {without: [(lang, KneserNey.of(levels)) for lang, levels in sorted(some.items())] for without, some in found.items()}


def _slices(texts: Iterator[tuple[int, str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row number, gram) arrays of up to SLICE symbols; long texts span several."""
    rows, grams, waiting = [], [], 0
    for row, text in texts:
        own = symbols(text) if text else ()
        if not len(own):
            continue
        found = four_grams(own)
        for start in range(0, len(found), SLICE):
            part = found[start : start + SLICE]
            rows.append(np.full(len(part), row, np.int64))
            grams.append(part)
            waiting += len(part)
            if waiting >= SLICE:
                yield np.concatenate(rows), np.concatenate(grams)
                rows, grams, waiting = [], [], 0
    if waiting:
        yield np.concatenate(rows), np.concatenate(grams)


def _entropies(texts: pd.Series, models: Models) -> tuple[np.ndarray, np.ndarray]:
    """Summed negative log probability per text and language, and symbols per text."""
    sums, lengths = np.zeros((len(models), len(texts))), np.zeros(len(texts))
    for rows, grams in _slices(enumerate(texts)):
        distinct, place = np.unique(grams, return_inverse=True)
        lengths += np.bincount(rows, minlength=len(texts))
        for at, (_, model) in enumerate(models):
            sums[at] -= np.bincount(rows, np.log(model.probabilities(distinct))[place], len(texts))
    return sums, lengths


def _predictions(texts: pd.Series, known: Models) -> pd.DataFrame:
    names = np.array([name for name, _ in known] or [UNDETERMINED], dtype=object)
    sums, lengths = _entropies(texts, known)
    if not known:
        sums, lengths = np.zeros((1, len(texts))), np.zeros(len(texts))
    best = sums.argmin(axis=0)
    least = sums.min(axis=0)
    posterior = 1.0 / np.exp(np.maximum(least - sums, -700.0)).sum(axis=0)
    blank = lengths == 0
    return pd.DataFrame(
        {
            "lang_pred": np.where(blank, UNDETERMINED, names[best]),
            "score": np.where(blank, 0.0, posterior),
            "cross_entropy": least / np.maximum(lengths, 1),
            "n_symbols": lengths.astype(np.int64),
        },
        index=texts.index,
    )


def predicted(text: Column, stored: Stored, without: Column | None = None) -> Column:
    """A struct of language, posterior probability, cross-entropy in nats per symbol, and length, by the models
    that leave out fold ``without``."""

    @F.pandas_udf(PREDICTION)
    def predict(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, folds in batches:
            parts = [_predictions(some, stored.models(fold)) for fold, some in texts.groupby(folds)]
            yield pd.concat(parts).sort_index() if parts else _predictions(texts, [])

    return predict(text, F.lit(WHOLE) if without is None else without)


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, fold, gram, n) over rows (lang, fold, text). Tasks add up their own counts first."""
    emit_at = 1 << 20

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([k for k, _ in parts])
        distinct, place = np.unique(keys, return_inverse=True)
        return distinct, np.bincount(place, np.concatenate([n for _, n in parts]))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, int], list] = {}
        pending = 0

        def out() -> Iterator[pd.DataFrame]:
            for (lang, fold), parts in held.items():
                keys, n = merged(parts)
                yield pd.DataFrame({"lang": lang, "fold": fold, "gram": keys.view(np.int64), "n": n.astype(np.int64)})

        for batch in batches:
            for key, texts in batch.groupby(["lang", "fold"])["text"]:
                for _, grams in _slices(enumerate(texts)):
                    keys, n = np.unique(grams, return_counts=True)
                    held.setdefault(key, []).append((keys, n))
                    pending += len(keys)
                    if pending > emit_at:
                        held = {name: [merged(parts)] for name, parts in held.items()}
                        pending = sum(len(p[0][0]) for p in held.values())
                        if pending > emit_at // 2:
                            yield from out()
                            held, pending = {}, 0
        yield from out()

    counted = docs.select("lang", "fold", "text").mapInPandas(count, "lang string, fold int, gram long, n long")
    return counted.groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n"))


def _lower(n: int) -> Column:
    """The last ``n`` symbols of column gram."""
    return F.col("gram").bitwiseAND(F.lit((1 << SYMBOL_BITS * n) - 1))


def fit(docs: DataFrame, staging: Staging, folds: int = 0) -> Stored:
    """Models of all languages in rows (lang, text), both not null, and if there are ``folds``, in column fold, also models
    without each of them: what KneserNey makes of all counts, by shuffles."""
    counts = count_grams(docs if folds else docs.withColumn("fold", F.lit(0)))
    fold = F.array(F.lit(WHOLE), *(F.when(F.col("fold") != k, F.lit(k)) for k in range(folds)))
    spread = counts.select("lang", F.explode(F.array_compact(fold)).alias("without"), "gram", "n")
    levels = {ORDER: staging.write(spread.groupBy("without", "lang", "gram").agg(F.sum("n").alias("n")), "grams")}
    for n in range(ORDER - 1, 0, -1):
        distinct = levels[n + 1].groupBy("without", "lang", _lower(n).alias("gram")).agg(F.count("*").alias("n"))
        levels[n] = staging.write(distinct, f"grams-{n}")
    every = None
    for n, level in levels.items():
        some = level.select("without", "lang", F.lit(n).alias("order"), "gram", "n", F.shiftrightunsigned("gram", SYMBOL_BITS).alias("context"))
        every = some if every is None else every.unionAll(some)
    once, twice = (F.count_if(F.col("n") == k) for k in (1, 2))
    discount = F.least(F.greatest(once / F.greatest(once + 2 * twice, F.lit(1)), F.lit(0.1)), F.lit(0.9))
    discounts = every.groupBy("without", "lang", "order").agg(discount.alias("discount"))
    heads = every.groupBy("without", "lang", "order", "context").agg(F.count("*").alias("types"), F.sum("n").alias("total")).join(discounts, ["without", "lang", "order"])
    left = F.col("discount") * F.col("types") / F.col("total")
    unsigned = lambda c: [F.col(c) < 0, F.col(c)]
    heads = heads.select("without", "lang", "order", F.col("context").alias("gram"), left.alias("value"), "total", "discount")
    heads = staging.write(heads.orderBy("without", "lang", "order", *unsigned("gram")), "contexts")
    below, full = None, []
    for n in range(1, ORDER + 1):
        of = heads.where(F.col("order") == n).select("without", "lang", F.col("gram").alias("context"), F.col("value").alias("left"), "total", "discount")
        rows = levels[n].withColumn("context", F.shiftrightunsigned("gram", SYMBOL_BITS)).join(of, ["without", "lang", "context"])
        lower = F.lit(1.0 / (1 << SYMBOL_BITS))
        if below is not None:
            under = below.select("without", "lang", F.col("gram").alias("under"), F.col("value").alias("lower"))
            rows, lower = rows.withColumn("under", _lower(n - 1)).join(under, ["without", "lang", "under"]), F.col("lower")
        value = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total") + F.col("left") * lower
        below = staging.write(rows.select("without", "lang", F.lit(n).alias("order"), "gram", value.alias("value")), f"level-{n}")
        full.append(below)
    together = full[0]
    for level in full[1:]:
        together = together.unionAll(level)
    together = staging.write(together.orderBy("without", "lang", "order", *unsigned("gram")), "model")
    sizes = lambda df: {(r["without"], r["lang"], r["order"]): r["n"] for r in df.groupBy("without", "lang", "order").agg(F.count("*").alias("n")).collect()}
    grams, contexts = sizes(together), sizes(heads)  # as many as folds times languages times orders
    # Spark orders strings by their bytes, as Python orders code points
    ordered = tuple((*key, grams[key], contexts[key]) for key in sorted(grams))
    return Stored(tuple(sorted(together.inputFiles())), tuple(sorted(heads.inputFiles())), ordered)


def _spread(sums: dict[str, float]) -> tuple[float, float]:
    """a and b, not negative, of the variance a + b / n of cross-entropies of n symbols; weighted least squares."""
    flat, inverse, squares, long_squares = sums["docs"], sums["inverse"], sums["squares"], sums["long_squares"]
    apart = sums["n"] * inverse - flat * flat
    if apart > 1e-9 * flat * flat:
        a, b = (inverse * long_squares - flat * squares) / apart, (sums["n"] * squares - flat * long_squares) / apart
        if a >= 0 and b >= 0:
            return a, max(b, 0.01)
        if b < 0:
            return long_squares / sums["n"], 0.01
    return 0.0, max(squares / inverse, 0.01)


def excess_limits(scored: DataFrame, languages: list[str]) -> dict[str, tuple[float, float, float]]:
    """Per language the expected cross-entropy, and a and b of its variance a + b / n_symbols, from documents that the models
    were not trained on. Rows: lang, lang_pred, cross_entropy, n_symbols.

    Means shrink towards the mean of the languages as far as the languages' means differ less than chance has it, and what
    stays unknown of a mean counts as variance; to the spread, the other languages add as many documents as
    ``LEANING``. Without two documents of one language there is no spread, and nothing is returned.
    """
    own = scored.where((F.col("lang") == F.col("lang_pred")) & (F.col("n_symbols") > 0))
    n, h = F.col("n_symbols").cast("double"), F.col("cross_entropy")
    terms = {"docs": F.lit(1.0), "h": h, "hh": h * h, "n": n, "nh": n * h, "nhh": n * h * h, "inverse": 1 / n}
    sums = {r["lang"]: r.asDict() for r in own.groupBy("lang").agg(*(F.sum(x).alias(k) for k, x in terms.items())).collect()}
    free = sum(x["docs"] - 1 for x in sums.values())
    if not free:
        return {}
    for x in sums.values():
        m = x["h"] / x["docs"]
        x["mean"] = m
        x["squares"] = max(x["hh"] - 2 * m * x["h"] + m * m * x["docs"], 0.0)
        x["long_squares"] = max(x["nhh"] - 2 * m * x["nh"] + m * m * x["n"], 0.0)
    pool = {k: sum(x[k] for x in sums.values()) for k in ("docs", "n", "inverse", "squares", "long_squares")}
    known = pool["docs"] / free  # each mean took a degree of freedom
    pool["squares"], pool["long_squares"] = pool["squares"] * known, pool["long_squares"] * known
    variance = pool["squares"] / pool["docs"]
    center = float(np.mean([x["mean"] for x in sums.values()]))
    apart = variance  # between languages, if only one was seen
    if len(sums) > 1:
        chance = np.mean([variance / x["docs"] for x in sums.values()])
        apart = max(float(np.var([x["mean"] for x in sums.values()], ddof=1) - chance), 0.0)
    limits = {}
    for lang in languages:
        x = sums.get(lang, dict.fromkeys([*pool, "mean"], 0.0))
        error = variance / x["docs"] if x["docs"] else math.inf
        trust = apart / (apart + error) if apart + error > 0 else 1.0
        a, b = _spread({k: x[k] + LEANING * pool[k] / pool["docs"] for k in pool})
        limits[lang] = trust * x["mean"] + (1 - trust) * center, a + apart * (1 - trust), b
    mean, a, b = (_looked_up(limits, "lang", k) for k in range(3))
    over = own.groupBy("lang").agg(F.sum((h - mean) ** 2 / (a + b / n)).alias("over")).collect()
    wider = {r["lang"]: max((r["over"] + LEANING) / (sums[r["lang"]]["docs"] + LEANING), 1.0) for r in over}
    return {lang: (m, a * wider.get(lang, 1.0), b * wider.get(lang, 1.0)) for lang, (m, a, b) in limits.items()}


def _looked_up(limits: dict[str, tuple[float, float, float]], lang: str, k: int) -> Column:
    """Number ``k`` of the limits of the language in column ``lang``."""
    if not limits:
        return F.lit(None).cast("double")
    return F.create_map(*(F.lit(x) for name, found in limits.items() for x in (name, float(found[k]))))[F.col(lang)]


def identify(
    spark: SparkSession,
    docs: DataFrame,
    training: DataFrame,
    staging: Staging,
    deviations: float = 12.0,
    folds: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``row`` with all columns of ``docs``, and beside it lang_pred, score and accepted.

    ``training`` has the columns doc_id, text and lang. All of it trains the models, and all of it calibrates the rejection:
    each of ``folds`` parts is scored by models of the others. By Chebyshev's inequality, about one in
    ``deviations`` squared documents like the calibration ones is rejected at most, whatever their distribution. Only
    where no two labelled documents of one language were recognised, nothing that has letters is rejected.
    """
    usable = training.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    part = F.floor(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) / 4) % folds
    usable = usable.select("lang", "text", part.cast("int").alias("fold"))
    models = fit(usable, staging, folds)
    calibration = usable.select("lang", predicted(F.col("text"), models, F.col("fold")).alias("p")).select("lang", "p.*")
    limits = excess_limits(staging.write(calibration, "calibration"), sorted({x[1] for x in models.sizes}))
    mean, a, b = (_looked_up(limits, "lang_pred", k) for k in range(3))
    excess = F.col("cross_entropy") - mean
    scored = docs.select(F.struct("*").alias("row"), predicted(F.col(text_col), models).alias("p")).select("row", "p.*")
    allowed = deviations * F.sqrt(a + b / F.greatest("n_symbols", F.lit(1)))
    accepted = (F.col("lang_pred") != UNDETERMINED) & F.coalesce(excess <= allowed, F.lit(True))
    return scored.select("row", "lang_pred", "score", accepted.alias("accepted"))


def trained_on(docs: DataFrame) -> DataFrame:
    """The documents that may be learned from: crc32 of the id modulo 4 is not 2."""
    return docs.select("doc_id", "text", "lang").where(crc_fold("doc_id", 4) != 2)


def op4_language_id(spark, sf_dir):
    """Per document: doc_id, held_out, lang_pred, score, accepted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(spark, docs.select("doc_id", "text"), trained_on(docs), Staging(spark))
    held_out = (crc_fold("row.doc_id", 4) == 2).alias("held_out")
    return found.select("row.doc_id", held_out, "lang_pred", "score", "accepted")
