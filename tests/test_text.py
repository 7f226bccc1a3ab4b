from pyspark.sql import functions as F

from tidepool.functions.text import java_split, split_lines, tokens


def _col(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn("s")).collect()]


def test_java_split_rules(spark):
    # Java "x".split(" "): trailing empties dropped, leading/inner kept,
    # "" gives [""], all-space gives [].
    got = _col(spark, ["", " ", "   ", " a  b ", "a b", "x  ", "a", None], java_split)
    assert got == [[""], [], [], ["", "a", "", "b"], ["a", "b"], ["x"], ["a"], None]


def test_split_lines_like_a_text_file(spark):
    got = _col(spark, ["", "a\n", "\n", "a\r\nb\rc\nd", "a\n\nb", "abc"], split_lines)
    assert got == [[], ["a"], [""], ["a", "b", "c", "d"], ["a", "", "b"], ["abc"]]


def test_tokens_keep_newlines_inside_records(spark):
    df = spark.createDataFrame([("a b\nc d",)], "value string")
    rec = [r.word for r in tokens(df, "value").collect()]
    assert rec == ["a", "b\nc", "d"]
    lines = [r.word for r in tokens(df, "value", split_lines_first=True).collect()]
    assert lines == ["a", "b", "c", "d"]


def test_tokens_match_python_reference_rule(spark):
    samples = ["", " ", " lead", "trail  ", "in  ner", "x", "  a b  c   "]

    def java_like(s):
        if s == "":
            return [""]
        parts = s.split(" ")
        while parts and parts[-1] == "":
            parts.pop()
        return parts

    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, value string")
    got = (tokens(df, "value", keep=("i",)).groupBy("i")
           .agg(F.count(F.lit(1)).alias("n")).collect())
    counts = {r.i: r.n for r in got}
    for i, s in enumerate(samples):
        assert counts.get(i, 0) == len(java_like(s)), s
