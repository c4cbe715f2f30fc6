from datetime import datetime

import pytest
from pyspark.sql import functions as F

from trendloom.functions import text, times, volume

EXPORT_TIMES = [
    ("March 9, 2031 at 6:45:30 PM UTC+2", datetime(2031, 3, 9, 16, 45, 30)),
    ("Mar 9, 2031 at 6:45:30 PM UTC+2", datetime(2031, 3, 9, 16, 45, 30)),
    ("March 9, 2031 at 6:45:30\u202fPM UTC+2", datetime(2031, 3, 9, 16, 45, 30)),
    ("\tMarch   9, 2031  at 6:45:30 PM UTC+2  ", datetime(2031, 3, 9, 16, 45, 30)),
    ("April 30, 2029 at 10:15:05 PM UTC-7", datetime(2029, 5, 1, 5, 15, 5)),
    ("February 1, 2028 at 12:30:00 AM UTC+9:30", datetime(2028, 1, 31, 15, 0)),
    ("February 1, 2028 at 12:30:00 AM UTC-330", datetime(2028, 2, 1, 4, 0)),
    ("June 07, 2030 at 12:00:00 PM UTC", datetime(2030, 6, 7, 12)),
    ("", None),
    (None, None),
    ("yesterday evening", None),
    ("June 2030", None),
    ("Junes 7, 2030 at 12:00:00 PM UTC", None),
    ("March 9, 2031 at 6:45:30 PM", None),
    ("March 9, 2031 at 6:45:30 PM UTC+44", None),
]
MONTHS = [datetime(2030, m, 17, 21, 40, 8) for m in range(1, 13)]


def one_column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")


def applied(spark, values, expression):
    found = one_column(spark, values).select("i", expression(F.col("v")).alias("x")).collect()
    return [r["x"] for r in sorted(found, key=lambda r: r["i"])]


def test_export_times(spark):
    assert applied(spark, [t for t, _ in EXPORT_TIMES], times.export_timestamp) == [w for _, w in EXPORT_TIMES]


@pytest.mark.parametrize("form", ["%B %d, %Y at %I:%M:%S %p UTC", "%b %d, %Y at %I:%M:%S %p UTC"])
def test_export_times_in_every_month(spark, form):
    texts = [m.strftime(form) for m in MONTHS]
    assert applied(spark, texts, times.export_timestamp) == MONTHS


def test_feed_times(spark):
    texts = ["Sat, 8 Feb 2031 22:30:00 -0500", "Sat, 08 Feb 2031 22:30:00 +00:00", "8 Feb 2031 22:30:00 -0500", "x", None]
    assert applied(spark, texts, times.feed_timestamp) == [
        datetime(2031, 2, 9, 3, 30), datetime(2031, 2, 8, 22, 30), None, None, None,
    ]
    texts = [m.strftime("%a, %d %b %Y %H:%M:%S +0000") for m in MONTHS]
    assert applied(spark, texts, times.feed_timestamp) == MONTHS


def test_epochs(spark):
    assert applied(spark, ["0", " 60 ", "x", "", None], times.epoch_timestamp) == [
        datetime(1970, 1, 1), datetime(1970, 1, 1, 0, 1), None, None, None,
    ]


def test_volumes(spark):
    bands = {
        "1000+": 1000, "50,000+": 50_000, "2K+": 2000, "5M+": 5_000_000, "1.5B+": 1_500_000_000, "+5m": 5_000_000,
        "20 k": 20_000, "N/A": 0, None: 0, "abc": 0, "1.2.3+": 0, "...": 0, "": 0, "99999999999B+": 0,
    }
    assert applied(spark, list(bands), volume.volume_min) == list(bands.values())


def test_text(spark):
    assert applied(spark, ["  a b\t", "  ", "", None], text.clean) == ["a b", None, None, None]
    assert applied(spark, ["a, b ,, c", "", None], text.split_list) == [["a", "b", "c"], [], []]
    assert applied(spark, ["ÉCoLe"], text.fold_ascii) == ["École"]
