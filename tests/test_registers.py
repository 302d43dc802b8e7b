"""Golden values for register frames (M2-M9) and device replies."""
from pyspark.sql import functions as F

from tallyho.functions import registers as R
from tallyho.operators import frames, readings


def test_crc_and_request(spark):
    df = spark.createDataFrame([(1, 3, 1, 1)], "a int, f int, s int, n int")
    r = df.select(F.hex(R.read_request(F.col("a"), F.col("f"), F.col("s"), F.col("n"))).alias("h")).first()
    assert r.h == "010300010001D5CA"   # CRC 0xCAD5, low byte first
    body = spark.createDataFrame([(bytes.fromhex("010300010001"),)], "b binary")
    assert body.select(R.crc16(R.byte_array(F.col("b")))).first()[0] == 0xCAD5


def test_decode_reply(spark):
    df = spark.createDataFrame([(1, bytes.fromhex("01030400FD0100"))], "event_id long, body binary")
    df = df.select("event_id", R.with_crc(F.col("body")).alias("frame"))
    replies = frames.decode_replies(df)
    regs = frames.registers_long(replies).orderBy("reg_index").collect()
    assert [r.value for r in regs] == [253, 256]
    assert (regs[0].scaled_int, regs[0].scaled, regs[0].value_hex) == (25, 25.3, "fd")
    assert replies.first().status == "ok"


def test_bad_frames(spark):
    rows = [(1, bytes.fromhex("01030400FD")), (2, bytes.fromhex("018302")), (3, bytes.fromhex("01030400FD0100"))]
    df = spark.createDataFrame(rows, "event_id long, body binary")
    df = df.select("event_id", F.when(F.col("event_id") == 3, F.concat("body", F.unhex(F.lit("0000"))))
                   .otherwise(R.with_crc(F.col("body"))).alias("frame"))
    got = {r.event_id: (r.status, r.exception_code) for r in frames.decode_replies(df).collect()}
    assert got == {1: ("short", None), 2: ("exception", 2), 3: ("bad_crc", None)}


def test_float_from_words(spark):
    import struct
    hi, lo = struct.unpack(">HH", struct.pack(">f", 26.93))
    df = spark.createDataFrame([(hi, lo), (0x7F80, 0), (0, 1)], "hi int, lo int")
    got = [r[0] for r in df.select(R.float_from_words(F.col("hi"), F.col("lo"))).collect()]
    assert got[0] == struct.unpack(">f", struct.pack(">f", 26.93))[0]
    assert got[1] == float("inf") and got[2] == 2.0 ** -149


def test_logical_address(spark):
    df = spark.createDataFrame([("3x", 0), ("4x", 100)], "b string, s int")
    assert [r[0] for r in df.select(R.logical_address(F.col("b"), F.col("s"))).collect()] == [30001, 40101]


def test_parse_replies(spark):
    rows = [(1, "{H00rdd 1;48.120; %RH;0;-;27.520;  degC; ;HF5         ;000;)\r"),
            (2, "{H00rdd 1;50.330; %rh;0;+;27.010;  °C;0;HF5;000;]\r\n"),
            (3, "{H00rdd 1;--.--;}"), (4, "{H00rdd 1;xx;%RH;0;-;27.5;degC;]")]
    df = spark.createDataFrame(rows, "event_id long, raw string").withColumn("ts", F.current_timestamp())
    parsed = readings.parse_replies(df)
    good = {r.event_id: (r.rh, r.temp_c, r.trend) for r in readings.good(parsed).collect()}
    assert good == {1: (48.12, 27.52, "-"), 2: (50.33, 27.01, "+")}
    bad = {r.event_id: r.reject_reason for r in readings.rejected(parsed).collect()}
    assert bad == {3: "too few fields", 4: "not a number"}
    dew = readings.with_dew_point(readings.good(parsed)).where("event_id = 1").first().dew_point_c
    assert 15.0 < dew < 16.0


def test_f14_helpers(spark):
    df = spark.createDataFrame([("1 3 0 1", "17")], "d string, o string")
    r = df.select(R.hex_text(R.bytes_from_decimal_text(F.col("d"))).alias("h"),
                  R.octal_to_decimal(F.col("o")).alias("n")).first()
    assert (r.h, r.n) == ("01030001", 15)


def test_latin1_replies(spark):
    from tallyho.functions.replies import latin1_text
    raw = "{H00rdd 1;48.120; %rh;0;-;27.520;  °C;]".encode("latin-1")
    df = spark.createDataFrame([(1, raw)], "event_id long, b binary").withColumn("ts", F.current_timestamp())
    parsed = readings.parse_replies(df.select("event_id", "ts", latin1_text("b").alias("raw")))
    r = readings.good(parsed).first()
    assert (r.rh, r.temp_c, r.temp_unit) == (48.12, 27.52, "degC")
