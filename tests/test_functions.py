import calendar as cal
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from docklake.functions import bands, calendar, measures, text

GOLDEN = datetime(2014, 5, 24, 14, 4, 6)


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first().asDict()


def test_calendar_of_golden_time(spark):
    parts = one(spark, **calendar.calendar_parts(F.lit(GOLDEN)))
    assert parts == {
        "minute": 4, "hour": 14, "daysixth": "[12:00 - 16:00)", "part": "LUNCH", "month_day": 24,
        "year_day": 144, "month_week": 4, "year_week": 21, "month": 5, "trimester": 2, "year": 2014,
    }


def test_calendar_in_another_zone(spark):
    local = calendar.in_zone(F.lit("2014-05-24 14:04:06").cast("timestamp_ntz"), "Europe/Madrid")
    parts = one(spark, **calendar.calendar_parts(local))
    assert (parts["hour"], parts["daysixth"], parts["part"]) == (16, "[16:00 - 20:00)", "AFTERNOON")


def test_utc_from_millis_ignores_the_session_zone(spark):
    got = one(spark, a=calendar.utc_from_millis(F.lit(1403452626123)), b=calendar.utc_from_millis(F.lit(-1)))
    assert got == {"a": datetime(2014, 6, 22, 15, 57, 6, 123000), "b": datetime(1969, 12, 31, 23, 59, 59, 999000)}


@pytest.mark.parametrize(
    "hour, sixth, part",
    [
        (0, 0, "NIGHT"), (3, 0, "NIGHT"), (4, 1, "NIGHT"), (5, 1, "NIGHT"), (6, 1, "GO-WORK"), (9, 2, "GO-WORK"),
        (10, 2, "MORNING"), (12, 3, "MORNING"), (13, 3, "LUNCH"), (14, 3, "LUNCH"), (15, 3, "AFTERNOON"),
        (16, 4, "AFTERNOON"), (17, 4, "BACK-HOME"), (18, 4, "BACK-HOME"), (19, 4, "NIGHT"), (20, 5, "NIGHT"),
        (23, 5, "NIGHT"),
    ],
)
def test_day_splits(spark, hour, sixth, part):
    at = F.lit(datetime(2014, 5, 24, hour, 59, 59))
    got = one(spark, sixth=calendar.day_sixth(at), part=calendar.day_part(at))
    assert got == {"sixth": calendar.DAY_SIXTHS[sixth], "part": part}


def week_of_month(day, first_weekday, minimal_days):
    """Weeks of the month by their definition: a leading piece shorter than ``minimal_days`` is week 0."""
    weeks = cal.Calendar(first_weekday).monthdatescalendar(day.year, day.month)
    in_month = [[d for d in week if d.month == day.month] for week in weeks]
    number = 0 if len(in_month[0]) < minimal_days else 1
    for week in in_month:
        if day in week:
            return number
        number += 1
    raise AssertionError(day)


def test_week_of_month_over_many_years(spark):
    start = date(2012, 1, 1)
    days = spark.range(4_000).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))
    got = days.select("day", calendar.month_week(F.col("day"), "us"), calendar.month_week(F.col("day"), "es")).collect()
    for day, us, es in got:
        assert us == week_of_month(day, cal.SUNDAY, 1), day
        assert es == week_of_month(day, cal.MONDAY, 4), day
    assert got[-1][0] == start + timedelta(3_999)
    known = {d: (us, es) for d, us, es in got}
    assert known[date(2014, 6, 1)] == (1, 0) and known[date(2014, 5, 31)] == (5, 5)


def test_unknown_week_rule():
    with pytest.raises(ValueError):
        calendar.month_week(F.lit(GOLDEN), "fr")


@pytest.mark.parametrize(
    "density, population, size, labels",
    [
        (9.99, 99, 4.99, ("[0 - 10)", "[0 - 100)", "[0 - 5)")),
        (10.0, 100, 5.0, ("[10 - 15)", "[100 - 150)", "[5 - 10)")),
        (15.0, 149, 10.0, ("[15 - 20)", "[100 - 150)", "[10 - 15)")),
        (20.0, 150, 15.0, ("[20 - 25)", "[150 - 20)", "[15 - 20)")),
        (25.0, 199, 19.9, ("[25 - 30)", "[150 - 20)", "[15 - 20)")),
        (30.0, 200, 20.0, ("[30+", "[200+", "[20+")),
        (35678.34, 266874, 7.48, ("[30+", "[200+", "[5 - 10)")),
        (None, None, None, (None, None, None)),
    ],
)
def test_district_bands(spark, density, population, size, labels):
    figures = [F.lit(density).cast("double"), F.lit(population).cast("bigint"), F.lit(size).cast("double")]
    assert tuple(one(spark, **bands.district_bands(*figures)).values()) == labels


def test_district_bands_in_thousands(spark):
    figures = [F.lit(24582.61), F.lit(160_000), F.lit(4.37)]
    got = one(spark, **bands.district_bands(*figures, label_mode="thousands"))
    assert tuple(got.values()) == ("[20 - 25)", "[150 - 200)", "[0 - 5)")
    with pytest.raises(ValueError):
        bands.district_bands(*figures, label_mode="other")


@pytest.mark.parametrize(
    "previous, bikes, status, expected",
    [
        (None, 9, "OPN", (5, 9, 14, 0, 0)),
        (-1, 9, "OPN", (5, 9, 14, 0, 0)),
        (0, 9, "OPN", (5, 9, 14, 0, 9)),
        (9, 4, "OPN", (5, 4, 9, 5, 0)),
        (4, 4, "OPN", (5, 4, 9, 0, 0)),
        (4, 7, "CLS", (0, 0, 0, 0, 3)),
        (7, 1, "OPN", (5, 1, 6, 6, 0)),
        (7, 1, None, (0, 0, 0, 6, 0)),
        (7, 1, "opn", (0, 0, 0, 6, 0)),
    ],
)
def test_fact_measures(spark, previous, bikes, status, expected):
    columns = measures.fact_measures(
        F.lit(status).cast("string"), F.lit(5), F.lit(bikes), F.lit(previous).cast("int")
    )
    assert tuple(one(spark, **columns).values()) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("21", 21), ("-3", -3), ("", 7), (" 7", 7), ("+5", 7), ("x", 7), ("2147483648", 7), (None, 7), ("007", 7)],
)
def test_int_or_default(spark, value, expected):
    assert one(spark, n=text.int_or(F.lit(value).cast("string"), 7))["n"] == expected


def test_int_list(spark):
    lists = one(spark, a=text.int_list(F.lit("24,x,,387")), b=text.int_list(F.lit("")), c=text.int_list(F.lit(None)))
    assert lists == {"a": [24, -1, -1, 387], "b": [-1], "c": None}


def test_updatetime(spark):
    good = F.lit("<a>\n<updatetime><![CDATA[1401551587]]></updatetime></a>")
    bad = F.lit("<updatetime>1401551587</updatetime>")
    huge = F.lit("<updatetime><![CDATA[99999999999999999999]]></updatetime>")
    got = one(spark, good=text.updatetime_millis(good), bad=text.updatetime_millis(bad), huge=text.updatetime_millis(huge))
    assert got == {"good": 1401551587000, "bad": None, "huge": None}


def test_geography_texts(spark):
    page = F.lit(" 107,426 hab (24.582,61 hab/km²)")
    got = one(
        spark,
        postal=text.postal_code(F.lit("Carrer de Casp 1, 08010 Barcelona, Spain")),
        elsewhere=text.postal_code(F.lit("Carrer Major 1, 17001 Girona, Spain")),
        size=text.district_size(F.lit("  4,37 km²")),
        no_size=text.district_size(F.lit("about 4,37")),
        population=text.district_population(page),
        density=text.district_density(page),
        address=text.address(F.lit("Ali Bei"), F.lit(44)),
        street=text.address(F.lit("Ali Bei"), F.lit(None)),
        nowhere=text.address(F.lit(None), F.lit(44)),
        quotes=text.double_quotes(F.lit("L'Antiga")),
        missing=text.null_text(F.lit("NULL")),
        point=text.point_text(F.lit(2.180042), F.lit(41.397952)),
        key=text.message_key(F.lit("bikes"), F.lit(1401551587000)),
        file=text.snapshot_file_time(F.lit("s3a://x/data/feed_2014-05-31_15.53.07_UTC.xml")),
        name=calendar.snapshot_name(F.lit(datetime(2014, 5, 31, 15, 53, 7))),
    )
    assert got == {
        "postal": "08010", "elsewhere": None, "size": 4.37, "no_size": None, "population": 107426,
        "density": 24582.61, "address": "Ali Bei 44", "street": "Ali Bei", "nowhere": "",
        "quotes": 'L"Antiga', "missing": None, "point": "POINT(2.180042 41.397952)",
        "key": "bikes1401551587000", "file": datetime(2014, 5, 31, 15, 53, 7),
        "name": "2014-05-31_15.53.07_UTC",
    }
    assert one(spark, y=calendar.current_year_text())["y"] in {str(datetime.now().year), str(datetime.now().year + 1)}
