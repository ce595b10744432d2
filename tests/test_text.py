from pyspark.sql import functions as F

from quillsieve.functions import text as X


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("r")).first()["r"]


def test_strip_is_unicode(spark):
    for value in ("　x \n", "\x1cx\x85", "x", "", " ", "​x"):
        assert one(spark, X.py_strip(F.col("v")), value) == value.strip()
    assert one(spark, X.py_strip(F.col("v")), None) is None


def test_ratios(spark):
    assert one(spark, X.latin_ratio(F.col("v")), "ab中文") == 0.5
    assert one(spark, X.latin_ratio(F.col("v")), "123") == 0.0
    assert one(spark, X.cjk_ratio_all(F.col("v")), "") == 0.0
    assert one(spark, X.approx_tokens(F.col("v")), "中文abc") == 3


def test_thinking(spark):
    assert one(spark, X.strip_think(F.col("v")), "<think>a</think>\nb<think>c") == "b"
    thinking, answer = X.split_think(F.col("v"))
    assert (one(spark, thinking, "<think>a</think>b</think>c"), one(spark, answer, "<think>a</think>b</think>c")) == ("a", "b</think>c")
    assert (one(spark, thinking, "plain"), one(spark, answer, " plain ")) == ("", "plain")
    assert one(spark, X.wrap_response(F.lit("t"), F.col("v")), "a") == "<think>\nt\n</think>\n\na"


def test_structure(spark):
    assert one(spark, X.between_tags(F.col("v"), "【功用】", ["【主治】", "【用法】"]), "【组成】a【功用】 b 【用法】c") == "b"
    assert one(spark, X.between_tags(F.col("v"), "【功用】", ["【主治】"]), "【功用】b") == "b"
    assert one(spark, X.between_tags(F.col("v"), "【功用】", ["【主治】"]), "b") is None
    assert one(spark, X.sentences(F.col("v")), "甲。乙！丙") == ["甲。", "乙！", "丙"]
    assert one(spark, X.html_text(F.col("v")), "<p>a<br/>b&nbsp;&lt;c&gt;</p><script>x<y</script>") == "a b <c>"
    assert one(spark, X.first_value(F.lit(" "), F.col("v")), " x ") == "x"
