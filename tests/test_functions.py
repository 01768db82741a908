import datetime as dt
import re
import string

import pytest
from pyspark.sql import functions as F

from rosterflow.functions import dates as D
from rosterflow.functions import paths as P
from rosterflow.functions import text as X


def values(spark, column, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_slug_strips_blank_and_punctuation_but_not_backslash(spark):
    text = "A b" + string.punctuation + "é\t9"
    expected = re.sub("[ " + string.punctuation + "]", "", text, flags=0).lower()
    assert values(spark, X.slug(F.col("a")), (text, "")) == [expected]


def test_person_id_is_null_when_a_part_is(spark):
    got = values(spark, X.person_id(F.col("b"), F.col("a")), ("Ada O'Test", "20190410"), (None, "20190410"), ("A", None))
    assert got == ["adaotest20190410", None, None]


@pytest.mark.parametrize(
    "day,month,expected",
    [
        ("10.0", "April 2019", dt.date(2019, 4, 10)),
        ("5", "SEPT 2019", dt.date(2019, 9, 5)),
        ("31.0", "Feb 2019", None),
        (None, "April 2019", None),
        ("10.0", None, None),
        ("x", "April 2019", None),
    ],
)
def test_invite_date(spark, day, month, expected):
    assert values(spark, D.invite_date(F.col("a"), F.col("b")), (day, month)) == [expected]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("Wednesday 1 May 2019", dt.date(2019, 5, 1)),
        ("1 May 2019", dt.date(2019, 5, 1)),
        ("Thursday, 12th September 2019", dt.date(2019, 9, 12)),
        ("August 22, 2019", dt.date(2019, 8, 22)),
        ("2019-08-22", dt.date(2019, 8, 22)),
        ("5/1/2019", dt.date(2019, 5, 1)),
        ("22/8/2019", dt.date(2019, 8, 22)),
        ("someday", None),
        (None, None),
    ],
)
def test_free_text_date(spark, text, expected):
    assert values(spark, D.free_text_date(F.col("a")), (text, "")) == [expected]


def test_repaired_date(spark):
    assert values(spark, D.parse_dmy(D.repair_slashes(F.col("a"))), ("22//08/2019", ""), ("no", "")) == [
        dt.date(2019, 8, 22),
        None,
    ]


def test_strict_date_fails_on_bad_text(spark):
    with pytest.raises(Exception, match="22-08"):
        values(spark, D.strict_dmy(F.col("a")), ("22-08-2019", ""))


def test_flags(spark):
    got = values(spark, F.struct(X.yes_no(F.col("a")), X.pass_fail(F.col("b"))), ("Yes", "Pass"), ("No", "Fail"), ("?", None))
    assert [tuple(r) for r in got] == [(True, 1), (False, 0), (None, None)]


def test_paths(spark):
    path = "file:/data/Academy/Data_Eng_28_2019-06-03.csv"
    assert values(spark, P.academy_course(F.col("a")), (path, "")) == ["Data_Eng"]
    assert values(spark, P.academy_date(F.col("a")), (path, "")) == [dt.date(2019, 6, 3)]
    assert values(spark, P.json_key(F.col("a")), ("s3a://b/Talent/10383.json", ""), ("s3a://b/Talent/x.json", "")) == [10383, None]


def test_weeks(spark):
    got = values(spark, F.struct(X.trait_of(F.col("a")), X.week_of(F.col("a"))), ("analytic_w10", ""))
    assert tuple(got[0]) == ("analytic", 10)
