"""Scalar column expressions: text, time, score and id helpers. All JVM-side, none a UDF."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Event prefix of the rating log line, and the split between seconds and milliseconds.
RATING_EVENT_PREFIX = "PRODUCT_RATING_PREFIX"
MILLIS_FROM = 100_000_000_000


def java_trim(c: Column) -> Column:
    """Strip every character up to U+0020 at both ends, not just blanks."""
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def parsed(c: Column, type_name: str, strict: bool = True) -> Column:
    """Cast text; bad input raises in strict mode (also with ANSI mode off) and is null otherwise."""
    value = c.try_cast(type_name)
    if not strict:
        return value
    message = F.concat(F.lit(f"not a valid {type_name}: "), F.coalesce(c, F.lit("null")))
    return F.coalesce(value, F.raise_error(message).cast(type_name))


def java_string_hash(c: Column) -> Column:
    """The 32-bit string hash used for user ids: h = 31*h + unit over UTF-16 code units."""
    two31, two32 = F.lit(1 << 31), F.lit(1 << 32)

    def hashed(units: Column) -> Column:
        n_units = (F.length(units) / 4).cast("int")
        starts = F.when(n_units > 0, F.sequence(F.lit(0), n_units - 1)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(
            starts,
            F.lit(0).cast("bigint"),
            lambda h, i: F.pmod(
                h * 31 + F.conv(F.substr(units, i * 4 + 1, F.lit(4)), 16, 10).cast("bigint"), two32
            ),
        )

    # bound as a lambda variable, or the text would be encoded anew for every unit
    unsigned = F.get(F.transform(F.array(F.hex(F.encode(c, "UTF-16BE"))), hashed), F.lit(0))
    return F.when(c.isNotNull(), (F.pmod(unsigned + two31, two32) - two31).cast("int"))


def redecode_utf8(c: Column) -> Column:
    """Undo reading UTF-8 bytes as Latin-1. What cannot be undone becomes '?' or U+FFFD, never an error."""
    latin = F.regexp_replace(c, r"[^\x00-\xff]", "?")
    return F.make_valid_utf8(F.encode(latin, "ISO-8859-1").cast("string"))


def tags_to_words(tags: Column, separator: str | None = "|") -> Column:
    """Put a blank where the tag separator stands; ``None`` leaves the text as it is."""
    return tags if separator is None else F.replace(tags, F.lit(separator), F.lit(" "))


def words(c: Column) -> Column:
    """Lower-cased words between runs of white space, without empty ones."""
    return F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")


def seconds_of(epoch: Column) -> Column:
    """Epoch seconds from a number holding either seconds or milliseconds."""
    return F.when(epoch > MILLIS_FROM, F.floor(epoch / 1000)).otherwise(epoch).cast("bigint")


def wall_clock_seconds(ts: Column) -> Column:
    """Epoch seconds of a zone-less timestamp read as UTC, whatever the session zone is."""
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def year_month(epoch_seconds: Column) -> Column:
    """yyyyMM as an int, in UTC; calendar arithmetic, so neither session zone nor text is involved."""
    day = F.date_from_unix_date(F.floor(epoch_seconds / 86400).cast("int"))
    return F.year(day) * 100 + F.month(day)


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def now_seconds() -> Column:
    return F.unix_seconds(F.current_timestamp())


def halved_score(stars: Column) -> Column:
    """The stored score for a ten-half-star vote: half of it, two decimals, half up."""
    return F.round(stars / 2, 2)


def star_position(average: Column) -> Column:
    """Where the ten-half-star display stands for a stored average."""
    return average * 2


def queue_key(user_id: Column) -> Column:
    return F.concat_ws(":", F.lit("userId"), user_id.cast("string"))


def queue_entry(product_id: Column, score: Column) -> Column:
    return F.concat_ws(":", product_id.cast("string"), score.cast("string"))


def rating_event(user_id: Column, product_id: Column, score: Column, seconds: Column) -> Column:
    """The tagged payload of one rating event, as it stands at the end of a log line."""
    fields = F.concat_ws("|", *[c.cast("string") for c in (user_id, product_id, score, seconds)])
    return F.concat_ws(":", F.lit(RATING_EVENT_PREFIX), fields)


def register_sql_functions(spark: SparkSession) -> None:
    """``changeDate(seconds)`` for SQL text; a SQL function, which Catalyst inlines."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION changeDate(s BIGINT) RETURNS INT RETURN "
        "year(date_from_unix_date(CAST(floor(s / 86400) AS INT))) * 100 "
        "+ month(date_from_unix_date(CAST(floor(s / 86400) AS INT)))"
    )
