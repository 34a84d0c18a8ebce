import re

import pytest
from pyspark.sql import functions as F

from logloom.operators.grok import expand, extract, first_spans, grok, group_names, group_numbers, library_with
from logloom.operators.grok_library import EVENT_TYPES, LIBRARY


def test_library_is_complete_and_compiles(spark):
    assert len(LIBRARY) == 102
    jvm = spark._jvm.java.util.regex.Pattern
    for name, regex in LIBRARY.items():
        jvm.compile(expand(regex))
    assert {"apache_access", "nginx_error", "mysql_general_query", "hadoop", "test"} <= set(EVENT_TYPES)


def test_groups_of_nested_references():
    names = group_names(expand(LIBRARY["nginx_error"]))
    assert "upstreamxport" in names and "referrerxport" in names
    assert len(group_names(expand(LIBRARY["COMMONAPACHELOG"]))) == 10


@pytest.mark.parametrize(
    "pattern, text, value",
    [
        ("UUID", "id 123e4567-e89b-12d3-a456-426614174000.", "123e4567-e89b-12d3-a456-426614174000"),
        ("MAC", "at 00:1A:2b:3c:4d:5e up", "00:1A:2b:3c:4d:5e"),
        ("IPV6", "from 2001:db8::1 x", "2001:db8::1 x".split()[0]),
        ("IPV4", "a 999.1.1.1 b 10.20.30.40", "10.20.30.40"),
        ("QS", 'say "a \\" b" end', '"a \\" b"'),
        ("UNIXPATH", "open /var/log/x.log ok", "/var/log/x.log"),
        ("WINPATH", r"open C:\temp\x", r"C:\temp\x"),
        ("TIMESTAMP_ISO8601", "at 2029-11-03T08:45:09.123+0800 end", "2029-11-03T08:45:09.123+0800"),
        ("DATESTAMP_RFC2822", "Sat, 03 Nov 2029 08:45:09 +0800", "Sat, 03 Nov 2029 08:45:09 +0800"),
        ("DATESTAMP_EVENTLOG", "20291103084509", "20291103084509"),
        ("LOGLEVEL", "x WARNING y", "WARNING"),
        ("BASE16FLOAT", "v 0x1F.8 w", "0x1F.8"),
        ("HOSTPORT", "to example.com:8080", "example.com:8080"),
        ("TTY", "on /dev/pts/12 now", "/dev/pts/12"),
    ],
)
def test_base_patterns(rows, pattern, text, value):
    df = extract(rows([(text,)], "t string"), "t", "X", library_with({"X": f"%{{{pattern}:v}}"}))
    assert df.first().v == value


def test_first_partial_match_and_no_match(rows):
    df = rows([("say 12 and 34",), ("none",), (None,)], "message string")
    out = grok("message", ["N"], {"N": "%{INT:n}"})(df).orderBy(F.col("message").desc_nulls_last()).collect()
    assert [r.n for r in out] == ["12", None, None]


def test_match_keeps_old_field_elsewhere_and_overwrites_on_match(rows):
    df = rows([("n=1", "old"), ("x", "old")], "message string, n string")
    out = grok("message", ["N"], {"N": "n=%{INT:n}"})(df).orderBy("message").collect()
    assert [r.n for r in out] == ["1", "old"]


def test_separator_in_text_is_harmless(rows):
    df = rows([("a\u0001b 7",)], "message string")
    assert grok("message", ["N"], {"N": "%{INT:n}"})(df).first().n == "7"


def test_separator_is_kept_in_values_and_positions(rows):
    library = library_with({"S": r"(?<w>[a\x{1}\x{2}b]+) %{INT:n}"})
    df = rows([("a\u0001b 7",), ("a\u0001\u0002b 7",)], "t string")
    out = df.select(first_spans("t", ["S"], library).alias("s")).orderBy(F.length("t")).collect()
    assert [tuple(x) for x in out[0].s] == [("w", 0, 3, "a\u0001b"), ("n", 4, 5, "7")]
    assert [tuple(x) for x in out[1].s] == [("w", 0, 4, "a\u0001\u0002b"), ("n", 5, 6, "7")]


@pytest.mark.parametrize("marks", ["\u0001\u0002\u0003", "\u0001\u0002\u0003\u0001\u0002\u0003", "\u0003\u0002\u0001", "\u0001\u0002", "\u0002\u0003", "\u0003"])
def test_text_with_separators_comes_back_whole(rows, marks):
    library = library_with({"S": r"^(?<w>[^ ]+) (?:(x)|%{INT:n})(?<no>#)?(?<end>.*)$"})
    df = rows([(f"a{marks}b 7{marks}",), (f"{marks} x{marks}",), (f"none{marks}",), (None,)], "t string")
    out = extract(df, "t", "S", library).collect()
    assert [(r.w, r.n, r.no, r.end) for r in out] == [(f"a{marks}b", "7", None, marks), (marks, None, None, marks), (None,) * 4, (None,) * 4]
    size = len(marks)
    spans = df.select(first_spans("t", ["S"], library).alias("s")).collect()
    assert [tuple(x) for x in spans[0].s] == [
        ("w", 0, size + 2, f"a{marks}b"), ("n", size + 3, size + 4, "7"), ("no", 0, 2 * size + 4, None), ("end", size + 4, 2 * size + 4, marks),
    ]
    assert spans[2].s is None


def test_group_numbers_count_all_capturing_groups(spark):
    regex = r"(a)(?<b>[(\]]x)\((?:y)(?<c>(z)(?=q))(?<!w)\Q(\E(?<d>.)"
    assert group_numbers(regex) == {"b": 2, "c": 3, "d": 5}
    line = '10.0.0.1 - u [03/Nov/2029:08:45:09 +0800] "GET /a?b=c HTTP/1.1" 200 5 "-" "agent"'
    full = expand(LIBRARY["apache_access"])
    m = spark._jvm.java.util.regex.Pattern.compile(full).matcher(line)
    assert m.find() and m.group("verb") == "GET"
    for name, number in group_numbers(full).items():
        assert (m.start(name), m.end(name)) == (m.start(number), m.end(number))


def test_multiline_text(rows):
    df = rows([("first\nsecond 9\nthird",)], "message string")
    assert grok("message", ["N"], {"N": "second %{GREEDYDATA:n}"})(df).first().n == "9"


def test_missing_target_column_changes_nothing(rows):
    df = rows([("x",)], "other string")
    assert grok("message", ["INT"])(df).columns == ["other"]


def test_one_regex_pass_per_pattern(spark, rows):
    df = grok("message", ["apache_access"])(rows([("x",)], "message string"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"regexp_replace\(", plan)) == 1


def test_spans(rows):
    df = rows([("ab 12 cd",), ("zz",)], "t string")
    library = library_with({"S": "(?<w>[a-z]+)(?<no>#)? %{INT:n}"})
    out = df.select(first_spans("t", ["S"], library).alias("s")).collect()
    assert [tuple(x) for x in out[0].s] == [("w", 0, 2, "ab"), ("no", 0, 8, None), ("n", 3, 5, "12")]
    assert out[1].s is None
