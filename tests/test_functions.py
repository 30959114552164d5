import hashlib
import hmac
from datetime import date

from pyspark.sql import functions as F

from caselake.functions import coding, identity, temporal, text
from caselake.plans import domain


def column(spark, values, build, kind="string"):
    """Apply a column function to a list of values, keeping their order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(build(F.col("v"))).collect()]


def test_null_spellings(spark):
    got = column(spark, ["", "  ", "nan", "NaN", "NULL", " None ", " x ", None], text.clean_text)
    assert got == [None] * 6 + ["x", None]


def test_names():
    assert text.snake_name("  Notificação (Data)--X ") == "notificacao_data_x"
    assert text.snake_name("RESUL_PCR_") == "resul_pcr"
    assert text.snake_name("¿?") == "unknown_column"


def test_strict_dates(spark):
    values = ["2024-02-29", "2024-02-31", "2024-1-5", "2024-13-01", "x", None, " 2024-01-05 "]
    assert column(spark, values, temporal.strict_date) == [
        date(2024, 2, 29), None, None, None, None, None, date(2024, 1, 5)
    ]
    late = column(spark, ["2199-01-01", "1999-01-01"],
                  lambda c: temporal.strict_date(c, temporal.ISO_DAY_20TH_21ST))
    assert late == [None, date(1999, 1, 1)]


def test_whole_numbers(spark):
    assert column(spark, ["12", "12.0", "x1", "", "1e3", "99999999999", None], temporal.safe_int) == [
        12, 12, None, None, None, None, None
    ]


def test_minutes_agree_over_offsets(spark):
    shown = column(
        spark, ["2026-08-03T17:06:49Z", "2026-08-03T14:06:49-03:00", "2026-08-03T17:06:49", "soon"],
        lambda c: F.date_format(temporal.minute_bucket(temporal.iso_instant(c)), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    )
    assert shown == ["2026-08-03T17:06:00Z"] * 3 + [None]


def test_decades_and_bands(spark):
    ages = [9, 35, 85, 0, 79, 80, None]
    assert column(spark, ages, coding.decade_band, "int") == [
        "00-09", "30-39", "80+", "00-09", "70-79", "80+", None
    ]
    bands = column(spark, [0, 4, 80, None, -1],
                   lambda c: coding.band_of(c, domain.AGE_BANDS, domain.AGE_BAND_MISSING), "int")
    assert bands == ["Menor de 1 ano", "1 a 4 anos", "80 anos ou mais", "Ignorada", "Ignorada"]


def test_person_numbers(spark):
    values = ["900.433.096-82", "90000000000", "11111111111", "123", "90043309681", None]
    assert column(spark, values, identity.person_number) == ["90043309682"] + [None] * 5
    assert column(spark, ["900433096"], identity.with_check_digits) == ["90043309682"]


def test_hmac_equals_the_standard(spark):
    for key in (b"k", b"x" * 64, b"y" * 100):
        inner, outer = (F.lit(bytearray(p)) for p in identity.key_pads(key))
        got = column(spark, ["90043309682"], lambda c: identity.hmac_sha256(c, inner, outer))
        assert got == [hmac.new(key, b"90043309682", hashlib.sha256).hexdigest()]


def test_shard(spark):
    assert column(spark, ["event-1"], lambda c: identity.hash_shard(c, 8)) == [7]


def test_content_hash_formats(spark):
    rows = spark.createDataFrame([("a||b", "c"), ("a", "b||c"), (None, "c")], "x string, y string")
    plain = [r[0] for r in rows.select(identity.content_hash(["y", "x"])).collect()]
    framed = [r[0] for r in rows.select(identity.content_hash(["y", "x"], framed=True)).collect()]
    assert plain[0] == plain[1] == hashlib.sha256(b"a||b||c").hexdigest()
    assert plain[2] == hashlib.sha256(b"<null>||c").hexdigest()
    assert len(set(framed)) == 3


def test_surrogate_keys(spark):
    rows = spark.createDataFrame([(None, None), ("a", None), ("a", "<unknown>")], "x string, y string")
    keys = [r[0] for r in rows.select(identity.surrogate_key(["x", "y"])).collect()]
    assert keys[0] == -1 and keys[1] == keys[2] != -1


def test_flags_are_three_valued(spark):
    rows = spark.createDataFrame(
        [("dengue", "13"), ("chikungunya", "13"), ("dengue", "5"), ("dengue", None)],
        "disease_name string, classification_code string",
    ).withColumn("confirmation_criterion_code", F.lit(None).cast("string"))
    flags = {f.name: f for f in domain.CASE_FLAGS}

    def values(name):
        return [r[0] for r in rows.select(coding.flag_value(flags[name])).collect()]

    assert values("is_confirmed_case") == [None, True, False, None]
    assert values("is_discarded_case") == [False, False, True, None]
    assert values("is_alarm_case") == [False, False, False, None]
    assert values("is_under_investigation") == [False, False, False, True]


def test_labels(spark):
    got = column(spark, ["M", "Z", None], lambda c: coding.label_of(c, domain.SEX, domain.UNMAPPED))
    assert got == ["Masculino", "Não mapeado", None]
