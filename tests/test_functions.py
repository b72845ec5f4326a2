import datetime
import unicodedata
import uuid

from pyspark.sql import functions as F

from ledgerline.functions import calendar, ids
from ledgerline.functions.text import clean_text, match_name
from ledgerline.rules import CORRECTED_SCORING, IGNORED, SCORING, STATS, event_kind, stat_increment


def cleaned(text, keep_punctuation=False):
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn").upper()
    if not keep_punctuation:
        bare = "".join(c if c.isspace() or c in "()" or (c.isascii() and c.isalnum()) else " " for c in bare)
    return " ".join(bare.split())


def test_clean_text_on_every_character(spark):
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    texts += ["Ñandú  (río) Ümlaut straße", "é̂x", "", "  ", "ﬁn İstanbul ŉ ǰ", "한국 Ά й", " x y\n"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select("t", clean_text(F.col("t")).alias("c")).collect():
        assert row.c == cleaned(row.t), repr(row.t)
    kept = ["Ñandú, río-2!", "한국 Ά й ", "éx y"]
    frame = spark.createDataFrame([(t,) for t in kept] + [(None,)], "t string")
    got = [r[0] for r in frame.select(clean_text(F.col("t"), remove_punctuation=False)).collect()]
    assert got == [cleaned(t, True) for t in kept] + [""]
    assert spark.range(1).select(clean_text(F.lit(None).cast("string"))).first()[0] == ""


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_identifiers(spark):
    space = uuid.UUID("dbb2ab43-b733-59f3-a2e8-17defebfcdaf")
    assert ids.NAMESPACE == space
    for text in ("", "TEAM_BOCA", "ñandú", "x" * 500):
        assert one(spark, ids.uuid5(F.lit(text))) == str(uuid.uuid5(space, text))
    assert one(spark, ids.team_id(F.lit("Boca"))) == "dc926617-07f5-5f10-92b2-ab8c85f89c28"
    assert one(spark, ids.player_id(F.lit(None).cast("string"))) == "865b9c0e-c859-5722-bc68-a6e294ded681"
    day = F.lit(datetime.datetime(2024, 1, 5, 23, 59))
    assert one(spark, ids.match_id(F.lit("Á b"), F.lit("C."), day)) == str(uuid.uuid5(space, "MATCH_20240105_A B_C"))
    args = [F.lit(x) for x in ("m", 2, "00:01:02.5", 7, "E")]
    assert one(spark, ids.event_id(*args)) == str(uuid.uuid5(space, "m_2_00:01:02_7_E"))
    nothing = F.lit(None).cast("string")
    assert one(spark, ids.event_id(nothing, nothing, nothing, nothing, nothing)) == str(uuid.uuid5(space, "unknown_0_00:00_0_"))


def test_identifier_cleaning(spark):
    cases = {" 12 ": "12", "12.0": "12", "1.05": "1.05", "0": None, "": None, "nan": None, "None": None, "0.0": None, "10": "10"}
    for raw, want in cases.items():
        assert one(spark, ids.clean_id(F.lit(raw))) == want
    assert one(spark, ids.sentinel_to_null(F.lit(-1))) is None and one(spark, ids.sentinel_to_null(F.lit("7"))) == "7"
    assert one(spark, match_name(F.lit(" GOMEZ ,  ANA "))) == "GOMEZ ANA"


def test_calendar(spark):
    assert one(spark, calendar.season_id(F.lit("2023-08-01").cast("date"))) == "liganacional20232024_basketball"
    assert one(spark, calendar.season_id(F.lit("2024-07-31"))) == "liganacional20232024_basketball"
    assert one(spark, calendar.file_timestamp(F.lit("a_b_202401052107.json"))) == datetime.datetime(2024, 1, 5, 21, 7)
    for bad in ("a_b", "a_2024", "a_202413992107", ""):
        assert one(spark, calendar.file_timestamp(F.lit(bad))) is None
    clocks = {"00:10:00.0": 600.0, "07:01:02.5": 62.5, "10:00": None, "a:b:c": None, "": None}
    for clock, seconds in clocks.items():
        assert one(spark, calendar.clock_seconds(F.lit(clock))) == seconds
    results = {("70", "60"): "HOME_WIN", ("1", "2.5"): "AWAY_WIN", ("5", "5"): "UNKNOWN", ("x", "5"): "UNKNOWN", ("nan", "5"): "UNKNOWN"}
    for (home, away), want in results.items():
        assert one(spark, calendar.match_result(F.lit(home), F.lit(away))) == want
    assert one(spark, calendar.match_result(F.lit(None).cast("int"), F.lit(3))) == "UNKNOWN"


def test_scoring_table(spark):
    assert one(spark, event_kind(F.lit("SALTO"))) == "PLAY" and one(spark, event_kind(F.lit(IGNORED[1]))) == "IGNORE"
    for table in (SCORING, CORRECTED_SCORING):
        codes = [(c,) for c in [*table, "OTHER"]]
        frame = spark.createDataFrame(codes, "code string")
        for row in frame.select("code", *[stat_increment(F.col("code"), s, table).alias(s) for s in STATS]).collect():
            assert {s: row[s] for s in STATS if row[s]} == table.get(row.code, {})
