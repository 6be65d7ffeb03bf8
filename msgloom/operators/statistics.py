"""Hand-made statistics per user.

All families share one pass. Every row measure is reduced to mergeable parts (count, sum, sum of
squares, bounds, bit set). Where signatures matter the parts are first grouped by (id, sign) and
then merged by id; that gives the signature figures in the same pass and splits busy users by
signature. Both steps combine before they shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgloom.config import MESSAGE_KEYWORDS
from msgloom.functions import identity, text
from msgloom.functions import time as clock
from msgloom.staging import Staging

TIME, CONTENT, SIGN, AREA, DISTRIBUTION = "time", "content", "sign", "area", "distribution"


@dataclass(frozen=True)
class Measure:
    """A number per row and the statistics wanted of it: mean, std, sum, min, max, nunique."""

    name: str
    value: Column
    stats: tuple[str, ...]


def time_measures(ts: Column) -> list[Measure]:
    return [
        Measure("hour", clock.hour(ts), ("mean", "std", "nunique")),
        Measure("day_of_week", clock.day_of_week(ts), ("nunique",)),
        Measure("is_weekend", clock.is_weekend(ts), ("mean", "sum")),
        Measure("is_work_time", clock.is_work_time(ts), ("mean", "sum")),
        Measure("is_night", clock.is_night(ts), ("mean", "sum")),
    ]


def content_measures(
    message: Column, keywords: dict[str, list[str]] | None, escaped_dollar: bool = False
) -> list[Measure]:
    measures = [
        Measure("message_length", text.message_length(message), ("mean", "std", "min", "max")),
        Measure("word_count", text.word_count(message), ("mean", "std")),
        Measure("digit_count", text.digit_count(message), ("mean", "sum")),
        Measure("punctuation_count", text.punctuation_count(message), ("mean", "sum")),
        Measure("amount_count", text.amount_count(message, escaped_dollar), ("sum",)),
    ]
    for prefix, words in (keywords or {}).items():
        measures.append(Measure(f"{prefix}_keyword_count", text.keyword_count(message, words), ("sum", "mean")))
    return measures


def distribution_measures(message: Column) -> list[Measure]:
    return [
        Measure("slash", text.slash_count(message), ("sum",)),
        Measure("url", text.url_count(message), ("sum",)),
    ]


# The parts that each statistic is made of.
_PARTS = {
    "mean": ("n", "s"),
    "std": ("n", "s", "q"),
    "sum": ("s",),
    "min": ("lo",),
    "max": ("hi",),
    "nunique": ("bits",),
}
_MERGE = {"n": F.sum, "s": F.sum, "q": F.sum, "lo": F.min, "hi": F.max, "bits": F.bit_or}


def _parts(measure: Measure) -> list[str]:
    wanted = {p for stat in measure.stats for p in _PARTS[stat]}
    return [p for p in _MERGE if p in wanted]


def _first_parts(measure: Measure) -> list[Column]:
    x = F.col(measure.name)
    build = {
        "n": lambda: F.count(x),
        "s": lambda: F.sum(x),
        # whole numbers below 2**53 are summed exactly, in any order
        "q": lambda: F.sum(x.cast("double") * x.cast("double")),
        "lo": lambda: F.min(x),
        "hi": lambda: F.max(x),
        "bits": lambda: F.bit_or(F.call_function("shiftleft", F.lit(1), x)),
    }
    return [build[p]().alias(f"{measure.name}__{p}") for p in _parts(measure)]


def _merged_parts(measure: Measure) -> list[Column]:
    return [_MERGE[p](f"{measure.name}__{p}").alias(f"{measure.name}__{p}") for p in _parts(measure)]


def _finished(measure: Measure) -> list[Column]:
    def part(p: str) -> Column:
        return F.col(f"{measure.name}__{p}")

    def std() -> Column:
        n, s, q = part("n").cast("double"), part("s").cast("double"), part("q")
        spread = F.greatest(n * q - s * s, F.lit(0.0))
        return F.when(n > 1, F.sqrt(spread / (n * (n - 1))))

    build = {
        "mean": lambda: F.when(part("n") > 0, part("s") / part("n")),
        "std": std,
        "sum": lambda: part("s"),
        "min": lambda: part("lo"),
        "max": lambda: part("hi"),
        "nunique": lambda: F.bit_count(part("bits")),
    }
    return [F.coalesce(build[stat](), F.lit(0)).alias(f"{measure.name}_{stat}") for stat in measure.stats]


@dataclass(frozen=True)
class Statistics:
    """The statistics of some families, as parts per (id, sign) that can be added up, and what is made of them.

    ``families`` and ``keywords`` settle the columns of the parts; ``message`` and ``ts`` are read from those columns.
    """

    families: tuple[str, ...]
    keywords: dict[str, list[str]] | None = None
    escaped_dollar: bool = False

    @property
    def measures(self) -> list[Measure]:
        message, ts = F.col("message"), F.col("ts")
        found: list[Measure] = []
        if TIME in self.families:
            found += time_measures(ts)
        if CONTENT in self.families:
            found += content_measures(message, self.keywords, self.escaped_dollar)
        if DISTRIBUTION in self.families:
            found += distribution_measures(message)
        return found

    @property
    def signs(self) -> bool:
        return SIGN in self.families or DISTRIBUTION in self.families

    def _plain(self) -> list[tuple[str, Column, Callable[[str], Column]]]:
        """Parts that belong to no measure: name, from rows, from parts."""
        plain = [("_rows", F.count(F.lit(1)), F.sum)]
        if DISTRIBUTION in self.families:
            plain += [
                ("_messages", F.sum("_has_message"), F.sum),
                ("_first", F.min("_ts"), F.min),
                ("_last", F.max("_ts"), F.max),
            ]
        return plain

    def parts(self, messages: DataFrame) -> DataFrame:
        """One row per non-null id, and per sign if a family needs it."""
        columns = [F.col("id")] + [m.value.alias(m.name) for m in self.measures]
        if DISTRIBUTION in self.families:
            columns += [F.col("message").isNotNull().cast("int").alias("_has_message"), F.col("ts").alias("_ts")]
        if self.signs:
            columns.append(F.col("sign"))
        rows = messages.where(F.col("id").isNotNull()).select(*columns)
        first = [c for m in self.measures for c in _first_parts(m)] + [c.alias(n) for n, c, _ in self._plain()]
        return rows.groupBy(*self.keys).agg(*first)

    @property
    def keys(self) -> list[str]:
        return ["id", "sign"] if self.signs else ["id"]

    def merged(self, parts: DataFrame, *more: str) -> DataFrame:
        """Parts of the same id and sign (and columns ``more``) added up."""
        sums = [c for m in self.measures for c in _merged_parts(m)] + [merge(n).alias(n) for n, _, merge in self._plain()]
        return parts.groupBy(*more, *self.keys).agg(*sums)

    def finished(self, parts: DataFrame, as_of: Column | None = None) -> DataFrame:
        """The statistics from parts with one row per id and sign, nulls replaced by zero."""
        users = parts
        if self.signs:
            signed = F.when(F.col("sign").isNotNull(), F.col("_rows"))
            users = parts.groupBy("id").agg(
                *[c for m in self.measures for c in _merged_parts(m)],
                F.count("sign").alias("_signs"),
                F.sum(signed).alias("_signed_rows"),
                F.max(signed).alias("_top_sign_rows"),
                *[merge(n).alias(n) for n, _, merge in self._plain()],
            )
        out: list[Column] = [F.col("id")]
        out += [c for m in self.measures if m.name not in ("slash", "url") for c in _finished(m)]
        if SIGN in self.families:
            out += [
                F.col("_signs").alias("unique_signs"),
                F.coalesce("_signed_rows", F.lit(0)).alias("total_messages"),
                F.coalesce(F.try_divide("_signs", "_signed_rows"), F.lit(0.0)).alias("sign_diversity_ratio"),
                F.coalesce(F.try_divide("_top_sign_rows", "_rows"), F.lit(0.0)).alias("dominant_sign_ratio"),
            ]
        if DISTRIBUTION in self.families:
            now = F.current_timestamp() if as_of is None else as_of
            out += [
                F.col("_messages").alias("message_count"),
                F.col("_signs").alias("sign_unique_count"),
                F.coalesce("slash__s", F.lit(0)).alias("slash_count"),
                F.coalesce("url__s", F.lit(0)).alias("url_count"),
                F.coalesce(F.col("_messages") / clock.days_between(F.col("_first"), F.col("_last")), F.lit(0.0)).alias(
                    "message_frequency"
                ),
                F.coalesce(clock.days_between(F.col("_last"), now), F.lit(0.0)).alias("days_since_last_message"),
            ]
        return users.select(*out)


def user_statistics(
    messages: DataFrame,
    families: tuple[str, ...],
    keywords: dict[str, list[str]] | None = None,
    as_of: Column | None = None,
    escaped_dollar: bool = False,
) -> DataFrame:
    """The statistics of the given families, one row per non-null id, nulls replaced by zero.

    ``messages`` has ``id``, ``ts`` (a timestamp) and, as the families need them, ``message`` and
    ``sign``. ``as_of`` is the time that "days since the last message" counts to.
    """
    wanted = Statistics(tuple(families), keywords, escaped_dollar)
    return wanted.finished(wanted.parts(messages), as_of)


def time_features(messages: DataFrame) -> DataFrame:
    return user_statistics(messages, (TIME,))


def content_features(messages: DataFrame, keywords: dict[str, list[str]] | None = None, escaped_dollar: bool = False) -> DataFrame:
    return user_statistics(messages, (CONTENT,), keywords, escaped_dollar=escaped_dollar)


def sign_features(messages: DataFrame) -> DataFrame:
    return user_statistics(messages, (SIGN,))


def distribution_features(messages: DataFrame, as_of: Column | None = None) -> DataFrame:
    return user_statistics(messages, (DISTRIBUTION,), as_of=as_of)


def _carriers_of_users(users: DataFrame) -> DataFrame:
    """Carrier totals from one row per user (``id``, ``message_count``)."""
    return users.groupBy(identity.carrier_code(F.col("id")).alias("carrier_code")).agg(
        F.count("id").alias("carrier_user_count"),
        F.sum("message_count").alias("carrier_message_count"),
    )


def _messages_per_user(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("id").isNotNull()).groupBy("id").agg(F.count("message").alias("message_count"))


def carrier_statistics(messages: DataFrame) -> DataFrame:
    """Users and non-null messages per carrier.

    Counting per user first replaces the distinct count, and keeps a large carrier from
    gathering its users' rows in one place.
    """
    return _carriers_of_users(_messages_per_user(messages))


def with_carrier_statistics(users: DataFrame, carriers: DataFrame) -> DataFrame:
    """Attach the carrier's totals to each user. Spark broadcasts ``carriers`` if it is small."""
    coded = users.withColumn("carrier_code", identity.carrier_code(F.col("id")))
    return coded.join(carriers, "carrier_code", "left").drop("carrier_code")


def area_features(messages: DataFrame, staging: Staging) -> DataFrame:
    """``carrier_user_count`` and ``carrier_message_count`` per user.

    Both users and carriers are written, so the messages are read once, and the join with the few carriers goes
    by their true size (or is split, where broadcasting is off).
    """
    users = staging.write(_messages_per_user(messages), "users")
    carriers = staging.write(_carriers_of_users(users), "carriers")
    return with_carrier_statistics(users, carriers).drop("message_count")


def all_statistics(
    messages: DataFrame,
    keywords: dict[str, list[str]] | None = None,
    language: str = "cn",
    as_of: Column | None = None,
    staging: Staging | None = None,
) -> DataFrame:
    """Every family for users with at least one dated message (39 columns; 37 if not Chinese).

    The carrier totals need the user table twice; with ``staging`` it is written once.
    """
    wanted = everything(keywords)
    users = wanted.finished(wanted.parts(messages.where(F.col("ts").isNotNull())), as_of)
    return with_carriers(users, language, staging)


def everything(keywords: dict[str, list[str]] | None = None) -> Statistics:
    """All families that :func:`all_statistics` takes from one pass."""
    return Statistics((TIME, CONTENT, SIGN, DISTRIBUTION), MESSAGE_KEYWORDS if keywords is None else keywords)


def with_carriers(users: DataFrame, language: str, staging: Staging | None) -> DataFrame:
    """The users' statistics, with the totals of their carriers in Chinese data."""
    if language != "cn":
        return users
    if staging is not None:
        users = staging.write(users, "users")
    carriers = _carriers_of_users(users)
    if staging is not None:
        carriers = staging.write(carriers, "carriers")
    joined = with_carrier_statistics(users, carriers)
    at = users.columns.index("message_count")
    return joined.select(
        *users.columns[:at], "carrier_user_count", "carrier_message_count", *users.columns[at:]
    )
