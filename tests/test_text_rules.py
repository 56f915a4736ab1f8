"""Hand-made cases for the text rules (expected values follow the rules)."""

from pyspark.sql import functions as F

from corpuslab.functions import text as T
from corpuslab.functions.presets import HEBREW, LATIN
from corpuslab.operators import sentences as SN
from corpuslab.operators import transcripts as TR


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"v {typ}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


def phrases(spark, text):
    pieces = one(spark, T.sentence_pieces, text, "string")
    return [p.strip() for p in pieces if p.strip()]


def test_split_keeps_decimals(spark):
    assert phrases(spark, "v 3.5 yes. no?") == ["v 3.5 yes.", "no?"]


def test_split_keeps_list_number(spark):
    assert phrases(spark, " see 2. item") == ["see 2. item"]


def test_split_doubled_mark(spark):
    assert phrases(spark, "ok!!") == ["ok!", "!"]


def test_tokenize_hebrew_abbreviations(spark):
    toks = one(spark, T.tokenize, 'ד"ר כהן, "שלום" על-ידי (א)!')
    assert toks == ['ד"ר', 'כהן', ',', '"', 'שלום"', 'על', '-', 'ידי', '(', 'א', ')', '!']


def test_clean_two_script_words_dropped(spark):
    assert one(spark, lambda c: T.clean_sentence(c, HEBREW), "שלום עולם") is None


def test_clean_dashes_dropped(spark):
    assert one(spark, lambda c: T.clean_sentence(c, HEBREW), "אחד שתיים שלוש -- ארבע") is None
    assert one(spark, lambda c: T.clean_sentence(c, HEBREW), "אחד שתיים שלוש - - ארבע") is None


def test_clean_removes_latin_words(spark):
    assert one(spark, lambda c: T.clean_sentence(c, HEBREW), "אחד two שתיים שלוש") == "אחד שתיים שלוש"


def test_mask_counts(spark):
    lens = [6, 9, 11, 15, 24, 25, 33, 60]
    df = spark.createDataFrame([(n,) for n in lens], "n int")
    got = [r["k"] for r in df.select(T.mask_count(F.col("n"), 0.1).alias("k")).collect()]
    assert got == [1, 1, 1, 2, 2, 3, 3, 6]


def test_file_metadata(spark):
    df = spark.createDataFrame([("25_ptv_1219728.docx",), ("19_abc_1.docx",)], "f string")
    k, t = SN.file_name_parts("f")
    rows = [tuple(r) for r in df.select(k, t).collect()]
    assert rows == [(25, "committee"), (19, "unknown")]


def test_protocol_number(spark):
    df = spark.createDataFrame([("פרוטוקול מס' 45, 46 של הוועדה",), ("nothing here",)], "t string")
    got = [r[0] for r in df.select(SN.protocol_number("t", HEBREW)).collect()]
    assert got == [45, -1]


def test_headers(spark):
    df = spark.createDataFrame([("name:", "f"), ("name: hello", "f"), ("a b c d e:", "f")], "t string, f string")
    got = [r[0] for r in df.select(TR.speaker_name(F.col("t"), F.col("f"), LATIN)).collect()]
    assert got == ["name", None, None]


def test_carry_forward_drops_paragraphs_before_first_header(spark):
    p = spark.createDataFrame([(1, "x.docx", 0, "x"), (1, "x.docx", 1, "A:"), (1, "x.docx", 2, "y")],
                              "file_id long, protocol_name string, para_idx long, text string")
    t = TR.turns(p, LATIN).collect()
    # the header's (empty) text after the colon seeds the turn, as in the reference
    assert [(r["speaker_name"], r["text"]) for r in t] == [("A", " y")]


def test_ws_tokens_unicode_whitespace(spark):
    assert one(spark, T.ws_tokens, "a b\tc  d") == ["a", "b", "c", "d"]


def test_strip_and_collapse_know_every_white_space(spark):
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"
    texts = [f"{s}{t}a{s}b{s}{t} c {t}{s}" for s in spaces for t in spaces] + ["", " ", "\n", "​a​"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    rows = df.select("x", T.py_strip("x").alias("s"), T.collapse_ws("x").alias("c")).collect()
    assert all(r.s == r.x.strip() and r.c == " ".join(r.x.split()) for r in rows)


def test_one_row_group_is_spread(spark, tmp_path):
    """A scan of many splits whose rows lie in one row group is one task's work."""
    from corpuslab.sources import tables
    spark.range(0, 60_000, 1, 1).selectExpr("id AS doc_id", "repeat(md5(cast(id AS string)), 30) AS text").write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        df = spark.read.parquet(str(tmp_path / "t"))
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        sizes = [r["count"] for r in tables.spread(df, "doc_id").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(sizes) == 60_000 and max(sizes) < 60_000 / spark.sparkContext.defaultParallelism
