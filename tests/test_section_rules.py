"""Cheap conditions before the rules of sections change no result."""

from docloom.constants import SECTION_RULES
from docloom.functions import text as tx
from pyspark.sql import functions as F

TEXTS = ["1.2 A 3", ".5 x ... 7", "Chapter IV", "ſection iv", "SECTION x", "İ part i", "Part v", "article 9", "Appendix B", "- x", "• y", "*\tz", "Fig. 3", "FIGURE 4", "Table 2", "tbl. 1", "x ± y", "é x", "", " ", "√", "٣ A", "9 A"]


def test_first_characters_refuse_nothing_that_fits(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for _, pattern, low in SECTION_RULES:
        fits = (F.lower("t") if low else F.col("t")).rlike(pattern)
        assert rows.filter(fits & ~tx._may_fit(F.col("t"), pattern, low)).count() == 0
        assert rows.filter(~tx._may_fit(F.col("t"), pattern, low)).count() > 0


def test_white_space_before_a_last_line_end_stays(spark):
    row = spark.createDataFrame([("abc \u0085", " \t a  b\n")], "x string, y string").select(tx.stripped(F.col("x")), tx.stripped(F.col("y")), tx.word_count(F.col("y")), tx.word_count(F.lit(" ")), tx.word_count(F.lit(None).cast("string"))).first()
    assert tuple(row) == ("abc \u0085", "a  b", 2, 0, None)  # as in the SQL, where $ is the end alone
