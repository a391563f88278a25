import pytest
from pyspark.sql import functions as F

from shelfsense.functions import scalars as sc
from shelfsense.functions.vectors import cosine, unit


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def java_hash(text):
    h = 0
    raw = text.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = (h * 31 + int.from_bytes(raw[i : i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


@pytest.mark.parametrize("text", ["hello", "", "a", "polygenelubricants", "ünï", "商品", "a😀b", "Customer#000000042"])
def test_string_hash(spark, text):
    assert value(spark, sc.java_string_hash(F.lit(text))) == java_hash(text)


def test_string_hash_known_values(spark):
    assert value(spark, sc.java_string_hash(F.lit("hello"))) == 99162322
    assert value(spark, sc.java_string_hash(F.lit("polygenelubricants"))) == -(1 << 31)
    assert value(spark, sc.java_string_hash(F.lit(None).cast("string"))) is None


def test_string_hash_encodes_a_text_once(spark):
    df = spark.range(2).select(sc.java_string_hash(F.col("id").cast("string")).alias("v"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("UTF-16BE") == 1


@pytest.mark.parametrize(
    "seconds, month", [(1260759144, 200912), (0, 197001), (-1, 196912), (1704067199, 202312), (1704067200, 202401)]
)
def test_month_is_utc_whatever_the_session_zone(spark, seconds, month):
    assert value(spark, sc.year_month(F.lit(seconds).cast("bigint"))) == month
    sc.register_sql_functions(spark)
    assert spark.sql(f"SELECT changeDate({seconds})").first()[0] == month


def test_wall_clock_is_utc_whatever_the_session_zone(spark):
    ts = F.lit("2024-03-10 02:30:00.999").cast("timestamp_ntz")
    assert value(spark, sc.wall_clock_seconds(ts)) == 1710037800


def test_seconds_from_either_unit(spark):
    assert value(spark, sc.seconds_of(F.lit(1260759144).cast("bigint"))) == 1260759144
    assert value(spark, sc.seconds_of(F.lit(1260759144999).cast("bigint"))) == 1260759144


@pytest.mark.parametrize("stars, stored", [(9.0, 4.5), (6.55, 3.28), (0.01, 0.01), (8.93, 4.47)])
def test_halved_score_rounds_half_up(spark, stars, stored):
    assert value(spark, sc.halved_score(F.lit(stars))) == stored


def test_trim_strips_control_characters_but_no_inner_or_wide_blanks(spark):
    assert value(spark, sc.java_trim(F.lit("\t a b\x01\n"))) == "a b"
    assert value(spark, sc.java_trim(F.lit("　a"))) == "　a"


def test_redecode(spark):
    assert value(spark, sc.redecode_utf8(F.lit("Ã¤"))) == "ä"
    assert value(spark, sc.redecode_utf8(F.lit("plain"))) == "plain"
    assert value(spark, sc.redecode_utf8(F.lit("商"))) == "?"
    assert value(spark, sc.redecode_utf8(F.lit("é"))) == "�"


def test_words(spark):
    tags = sc.tags_to_words(F.lit("Red||Blue Sky|"), "|")
    assert value(spark, sc.words(tags)) == ["red", "blue", "sky"]
    assert value(spark, sc.words(sc.tags_to_words(F.lit("Red|Blue"), None))) == ["red|blue"]
    assert value(spark, sc.words(F.lit(""))) == []


def test_queue_and_event_text(spark):
    assert value(spark, sc.queue_key(F.lit(7))) == "userId:7"
    assert value(spark, sc.queue_entry(F.lit(3), F.lit(4.5))) == "3:4.5"
    event = sc.rating_event(F.lit(-7), F.lit(3), F.lit(4.5), F.lit(99))
    assert value(spark, event) == "PRODUCT_RATING_PREFIX:-7|3|4.5|99"


def test_zero_vectors_have_no_direction(spark):
    zero, one = F.lit([0.0, 0.0]), F.lit([3.0, 4.0])
    assert value(spark, unit(zero)) is None
    assert value(spark, unit(one)) == [0.6, 0.8]
    assert value(spark, cosine(zero, one)) is None
    assert value(spark, cosine(one, one)) == pytest.approx(1.0)


def test_now(spark):
    row = spark.range(1).select(sc.now_millis().alias("ms"), sc.now_seconds().alias("s")).first()
    assert row.ms // 1000 == row.s
