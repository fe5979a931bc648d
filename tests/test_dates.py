from datetime import date

from saldomart.functions.dates import chosen_formats, parse_dates, parse_dates_by_file


def test_formats_blanks_and_bad_texts(spark):
    rows = [
        (1, "2018-01-09"), (2, "09.01.2018"), (3, "09-01-2018"), (4, "20180109"), (5, " 2018-01-09 "),
        (6, "31.02.2018"), (7, "09.01.18"), (8, "junk"), (9, ""), (10, None), (11, "  "),
    ]
    good, bad = parse_dates(spark.createDataFrame(rows, "id int, d string"), ["d"])
    parsed = {r["id"]: r["d"] for r in good.collect()}
    assert parsed == {**{i: date(2018, 1, 9) for i in range(1, 6)}, 9: None, 10: None, 11: None}
    assert {(r["id"], r["d"], r["reason"]) for r in bad.collect()} == {
        (6, "31.02.2018", "bad date: d"), (7, "09.01.18", "bad date: d"), (8, "junk", "bad date: d"),
    }


def test_all_bad_columns_are_named(spark):
    df = spark.createDataFrame([("x", "2018-01-01", "y")], "a string, b string, c string")
    good, bad = parse_dates(df, ["a", "b", "c"])
    assert good.count() == 0
    assert bad.first()["reason"] == "bad date: a, c"


def test_formats_are_a_parameter(spark):
    df = spark.createDataFrame([("2018/01/09",)], "d string")
    good, bad = parse_dates(df, ["d"], ["yyyy/MM/dd"])
    assert (good.first()["d"], bad.count()) == (date(2018, 1, 9), 0)


def test_formats_without_fixed_width(spark):
    df = spark.createDataFrame([("9.1.2018",), ("9 Jan 2018",), ("1/9/2018",)], "d string")
    good, bad = parse_dates(df, ["d"], ["d.M.yyyy", "d MMM yyyy"])
    assert {r["d"] for r in good.collect()} == {date(2018, 1, 9)}
    assert [r["d"] for r in bad.collect()] == ["1/9/2018"]


FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")
FILES = {
    "days first": ["09/01/2018", "31/01/2018", None, " "],
    "months first": ["09/01/2018", "01/31/2018"],
    "either": ["09/01/2018", "10/02/2018"],
    "equal": ["09/09/2018", "10/10/2018"],
    "clear": ["2018-01-09", "2018-12-31"],
    "clear and a date of either": ["2018-01-09", "09/01/2018"],
    "both first": ["31/01/2018", "01/31/2018", "09/01/2018", "08/08/2018"],
    "junk": ["2018-01-09", "x", "31/31/2018"],
    "none": [None, ""],
    None: ["31/01/2018"],
}


def _texts(spark):
    rows = [(name, text, i) for name, texts in FILES.items() for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "file string, d string, n int")


def test_formats_are_found_by_file(spark):
    found = chosen_formats(_texts(spark), ["d"], FORMATS, "file").collect()
    assert {r["file"]: (r["n_texts"], r["n_unread"], r["n_conflicts"], r["format"], r["status"]) for r in found} == {
        "days first": (2, 0, 1, "dd/MM/yyyy", "decided"),
        "months first": (2, 0, 1, "MM/dd/yyyy", "decided"),
        "either": (2, 0, 2, None, "ambiguous"),
        "equal": (2, 0, 0, "dd/MM/yyyy", "clear"),
        "clear": (2, 0, 0, "yyyy-MM-dd", "clear"),
        "clear and a date of either": (2, 0, 1, None, "ambiguous"),
        "both first": (4, 0, 1, None, "ambiguous"),
        "junk": (3, 2, 0, "yyyy-MM-dd", "clear"),
        "none": (0, 0, 0, None, "clear"),
        None: (1, 0, 0, "dd/MM/yyyy", "clear"),
    }


def test_dates_by_file_are_not_guessed(spark):
    parsed, rejects = parse_dates_by_file(_texts(spark), ["d"], "file", FORMATS)
    dates = {(r["file"], r["n"]): r["d"] for r in parsed.collect()}
    ninth, last = date(2018, 1, 9), date(2018, 1, 31)
    assert dates == {
        ("days first", 0): ninth, ("days first", 1): last, ("days first", 2): None, ("days first", 3): None,
        ("months first", 0): date(2018, 9, 1), ("months first", 1): last,
        ("equal", 0): date(2018, 9, 9), ("equal", 1): date(2018, 10, 10),
        ("clear", 0): ninth, ("clear", 1): date(2018, 12, 31), ("clear and a date of either", 0): ninth,
        ("both first", 0): last, ("both first", 1): last, ("both first", 3): date(2018, 8, 8),
        ("junk", 0): ninth, ("none", 0): None, ("none", 1): None, (None, 0): last,
    }
    assert {(r["file"], r["n"], r["reason"], r["d"]) for r in rejects.collect()} == {
        ("either", 0, "ambiguous date: d", "09/01/2018"), ("either", 1, "ambiguous date: d", "10/02/2018"),
        ("clear and a date of either", 1, "ambiguous date: d", "09/01/2018"),
        ("both first", 2, "ambiguous date: d", "09/01/2018"),
        ("junk", 1, "bad date: d", "x"), ("junk", 2, "bad date: d", "31/31/2018"),
    }
