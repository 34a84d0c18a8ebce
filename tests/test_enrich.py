import pytest
from pyspark.sql import functions as F

from logloom.functions import dates, predicates as p
from logloom.functions.cols import last_wins_map, running_starts
from logloom.operators import anomaly, json_fields, mutate, split_kv, useragent, xml_fields
from logloom.operators.dates import date
from logloom.operators.geo import geo, ip_hex, ranges_from_cidr
from logloom.plans.steps import require, route


def one(df, expr):
    return df.select(expr.alias("x")).first().x


@pytest.fixture(scope="module")
def unit(spark):
    return spark.range(1)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a=1&b=2&a=3", {"a": "3", "b": "2"}),
        ("a=&=b&c&d=e=f", {"a": "", "": "b", "d": "e=f"}),
        ("only", None),
        ("", None),
        (None, None),
    ],
)
def test_kv(rows, text, expected):
    df = split_kv.kv("t", "&", "=")(rows([(text,)], "t string"))
    assert df.first().t_map == expected


def test_kv_without_sub_delimiter_is_no_op(rows):
    assert split_kv.kv("t", "&", "")(rows([("a=1",)], "t string")).first().t_map is None


def test_split_names_and_limit(rows):
    df = rows([("a?b?c",), ("a",), ("",), (None,)], "t string")
    out = split_kv.split("t", r"\?", 2, ["p", "q", "r"])(df).collect()
    assert [(r.p, r.q, r.r) for r in out] == [("a", "b?c", None), ("a", None, None), (None, None, None), (None, None, None)]
    assert split_kv.split("t", r"\?")(df).first().t_parts == {"0": "a", "1": "b", "2": "c"}


@pytest.mark.parametrize("text, size", [("a,b,,", 2), (",,", 0), ("a", 1), ("a,,b", 3), ("", 1)])
def test_split_limit_zero(rows, text, size):
    assert one(rows([(text,)], "t string"), F.size(split_kv.split_parts(F.col("t"), ",", 0))) == size


def test_split_spans_limit(rows):
    df = rows([("a--b-c",)], "t string")
    assert [tuple(x) for x in one(df, split_kv.split_spans(F.col("t"), "-+", 1))] == [(0, 1, "a"), (3, 6, "b-c")]


def test_running_starts_across_blocks(unit):
    n = 1500
    lengths = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x % 7)
    got = one(unit, running_starts(lengths))
    want, total = [], 0
    for i in range(1, n + 1):
        want.append(total)
        total += i % 7
    assert got == want


def test_last_wins_map_of_empty(unit):
    assert one(unit, last_wins_map(F.array().cast("array<struct<k:string,v:string>>"))) == {}


def test_kv_spans(rows):
    df = rows([("a=1&b&&c=2=3",)], "t string")
    got = [tuple(x) for x in one(df, split_kv.kv_spans(F.col("t"), "&", "="))]
    assert got == [("a", 2, 3, "1"), ("b", 4, 5, "b"), ("c", 9, 10, "2")]


@pytest.mark.parametrize(
    "text, fmt, tz, millis",
    [
        ("03/Nov/2029:08:45:09 +0800", "dd/MMM/yyyy:HH:mm:ss Z", "UTC", 1888361109000),
        ("3/Nov/2029:8:45:09 +08:00", "dd/MMM/yyyy:HH:mm:ss Z", "UTC", 1888361109000),
        ("03/Nov/2029:00:45:09 Z", "dd/MMM/yyyy:HH:mm:ss Z", "UTC", 1888361109000),
        ("Sat Nov 03 08:45:09 2029", "E MMM dd HH:mm:ss YYYY", "Asia/Shanghai", 1888361109000),
        ("2029/11/03 08:45:09", "yyyy/MM/dd HH:mm:ss", "Asia/Shanghai", 1888361109000),
        ("20291103084509", "yyyyMMddHHmmss", "Asia/Shanghai", 1888361109000),
        ("1888361109000", "epoch_millis", "UTC", 1888361109000),
        ("junk", "dd/MMM/yyyy:HH:mm:ss Z", "UTC", None),
        (None, "dd/MMM/yyyy:HH:mm:ss Z", "UTC", None),
    ],
)
def test_dates(rows, text, fmt, tz, millis):
    assert one(rows([(text,)], "t string"), dates.parse_millis(F.col("t"), fmt, tz)) == millis


def test_dates_do_not_depend_on_session_zone(spark, rows):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = rows([("2029/11/03 08:45:09",)], "t string")
        assert one(df, dates.parse_millis(F.col("t"), "yyyy/MM/dd HH:mm:ss", "Asia/Shanghai")) == 1888361109000
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_date_fallback(rows):
    df = rows([("bad",)], "timestamp string")
    assert date("timestamp", [("yyyy",)], fallback_now=True, now=5)(df).first().event_timestamp == 5
    assert date("timestamp", [("yyyy",)])(df).first().event_timestamp is None


@pytest.mark.parametrize(
    "ip, tail",
    [
        ("10.0.0.1", "ffff0a000001"),
        ("256.0.0.1", None),
        ("1.2.3", None),
        ("::1", "000000000001"),
        ("::ffff:10.0.0.1", "ffff0a000001"),
        ("2001:DB8::A", "00000000000a"),
        ("1:2:3:4:5:6:7:8:9", None),
        ("1::2::3", None),
        ("host", None),
        (None, None),
    ],
)
def test_ip_hex(rows, ip, tail):
    got = one(rows([(ip,)], "ip string"), ip_hex("ip"))
    assert got is None if tail is None else (len(got) == 32 and got.endswith(tail))


@pytest.mark.parametrize("limit", [200_000, 0])
def test_geo(rows, limit):
    blocks = rows(
        [("10.0.0.0/8", "A"), ("11.0.0.0/20", "B"), ("2001:db8::/32", "C"), ("11.0.16.128/25", "D")], "network string, city string"
    ).withColumns({"country": F.lit("X"), "continent": F.lit("Y")})
    ips = ["10.200.3.4", "11.0.15.255", "11.0.16.0", "11.0.16.200", "127.0.0.1", "2001:db8:1::5", "2001:db9::1", "junk", None]
    out = geo(ranges_from_cidr(blocks), broadcast_rows=limit)(rows([(i, ip) for i, ip in enumerate(ips)], "n int, clientip string"))
    assert [r.city for r in out.orderBy("n").collect()] == ["A", "B", None, "D", None, "C", None, None, None]


@pytest.mark.parametrize(
    "agent, browser, os",
    [
        ('"Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1)"', "IE9", "WINDOWS_7"),
        ("Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko", "IE11", "WINDOWS_7"),
        ("my-Bot-x/1", "My-Bot-x", "UNKNOWN"),
        ("SomeRobot/1.0 (robot)", "SomeRobot", "UNKNOWN"),
        ("Sogou web spider/4.0", "Spider", "UNKNOWN"),
        ("wget/1.1", "Wget", "UNKNOWN"),
        ("", "UNKNOWN", "UNKNOWN"),
        (None, None, None),
    ],
)
def test_user_agent(rows, agent, browser, os):
    r = useragent.user_agent("agent")(rows([(agent,)], "agent string")).first()
    assert (r.agent_browser, r.agent_os) == (browser, os)


@pytest.mark.parametrize(
    "text, paths, level, expected",
    [
        ('{"a":{"b":1.0,"c":"x"},"d":null,"e":[true,1e3]}', ["$"], 3, {"b": "1.0", "c": "x", "0": "true", "1": "1000.0"}),
        ('{"a":{"b":{"c":1}}}', ["$"], 1, {"a": '{"b":{"c":1}}'}),
        ('{"a":{"b":5}}', ["$.a.b", "$.no"], 3, {"a-b": "5"}),
        ('{"a":[{"x":1},{"x":2}]}', ["$.a[*].x"], 3, {"0": "1", "1": "2"}),
        ('{"s":"{\\"in\\":1}"}', ["$"], 3, {"s": '{"in":1}'}),
        ('{"n":123456789012345678901234567890}', ["$"], 3, {"n": "123456789012345678901234567890"}),
        ("[1,[2]]", ["$"], 3, {"0": "2"}),
        ("{bad", ["$"], 3, None),
        ("", ["$"], 3, None),
        (None, ["$"], 3, None),
    ],
)
def test_json_flatten(rows, text, paths, level, expected):
    got = one(rows([(text,)], "t string"), json_fields.flatten(F.col("t"), paths, level))
    assert got == expected


def test_unsupported_json_path_is_refused():
    for path in ("$..", "$...x", "x", "$[?(@.a =~ 'b')]", "$.a[1,'b']", "$.a[?]"):
        with pytest.raises(ValueError):
            json_fields.path_name(path)
    assert json_fields.path_name("$.a..b[0]['c'][*][1:2].length()") == "a-b-0-c-length"


@pytest.mark.parametrize(
    "path, expected",
    [
        ("$..b", ["1", "[5,6]", "2"]), ("$.a..b", ["1"]), ("$..b[0]", ["5"]), ("$..*.b", ["1", "2", "[5,6]"]), ("$.l[0,2]", ["10", "30"]),
        ("$.l[1:]", ["20", "30", "40"]), ("$.l[:2]", ["10", "20"]), ("$.l[-2:]", ["30", "40"]), ("$.l[1:-1]", ["20", "30"]), ("$.l[9:]", []),
        ("$.l[-1]", ["40"]), ("$.l[-9]", []), ("$.l[5,0]", ["10"]), ("$['k','none']", ['{"k":"v"}']), ("$.o[?(@.n > 1)].t", ["y", "z"]),
        ("$.o[?(@.t == 'x')].n", ["1"]), ("$.o[?(@.n >= 2 && @.t != 'z')].t", ["y"]), ("$.o[?(@.n == 1 || @.t == 'z')].n", ["1", "3"]),
        ("$.o[?(@.f)].n", ["3"]), ("$.o[?(@.f == true)].n", ["3"]), ("$.o[?(@['n'] == '1')].n", []), ("$.l[?(@ > 25)]", ["30", "40"]), ("$.a[?(@.b == 1)].c.d", ["0"]),
        ("$..length()", ["7", "2", "1", "1", "1", "2", "2", "4", "3", "2", "2", "3"]), ("$.no..x", []), ("$.o[*].t", ["x", "y", "z"]),
    ],
)
def test_json_paths_that_select_several(rows, path, expected):
    text = (
        '{"a":{"b":1,"c":{"d":0}},"e":[{"b":[5,6]}],"h":{"b":2,"g":null},"k":"v","l":[10,20,30,40],'
        '"o":[{"n":1,"t":"x"},{"n":2,"t":"y"},{"n":3,"t":"z","f":true}],"z":null}'
    )
    found = json_fields._walk(json_fields.parsed(F.col("t")), json_fields._tokens(path))
    got = one(rows([(text,)], "t string"), F.transform(found, json_fields._text))
    assert got == expected


def test_xml_flatten(rows):
    text = '<a id="1"><b x="y"> t </b><c><![CDATA[ raw ]]></c><!-- note --></a>'
    df = rows([(text,), ("<a>",), (None,)], "t string")
    got = [r.x for r in df.select(xml_fields.xml_flatten("t", ["/a"]).alias("x")).collect()]
    assert got[0] == {"#id": "1", "a#x": "y", "a-b": "t", "a-c#cdata-section": "raw", "a#comment": "note"}
    assert got[1:] == [None, None]
    attr = df.select(xml_fields.xml_flatten("t", ["/a/@id", "//b/text()"], 1).alias("x")).first().x
    assert attr == {"id": "1", "": "t"}


def test_xml_paths_with_positions_tests_and_depth(rows):
    text = "<a><b k='x'>1</b><b k='y'>2<c> 3 </c></b><d><b>4</b><b>&#x41;&amp;lt;&#8364;</b></d></a>"
    paths = {
        "first": "/a/b[1]/text()", "second": "/a/b[2]/text()", "tested": "/a/b[@k='y']/c/text()", "deep": "//b/text()", "inner": "/a//b[2]/text()",
        "star": "/a/*/c/text()", "attr": "//@k", "none": "/a/b[3]/text()", "both": "/a/d/b[1]/text()",
    }
    got = xml_fields.xml_values("t", paths)(rows([(text,)], "t string")).first()
    want = {"first": "1", "second": "2", "tested": "3", "deep": "A&lt;€", "inner": "A&lt;€", "star": "3", "attr": "y", "none": None, "both": "4"}
    assert {k: got[k] for k in paths} == want
    with pytest.raises(ValueError):
        xml_fields.xml_values("t", {"x": "/a/b[position()=1]"})(rows([(text,)], "t string"))


def test_xml_flatten_against_a_document_tree(rows):
    """The fold against a DOM of the standard library, on generated documents and on broken ones."""
    import random
    from xml.dom import Node, minidom
    from xml.parsers.expat import ExpatError

    def entries(node, above=()):
        if node.nodeType == Node.ELEMENT_NODE:
            for k, v in node.attributes.items():
                yield "-".join(above) + "#" + k, v
            for child in node.childNodes:
                yield from entries(child, (*above, node.nodeName))
        elif (node.nodeValue or "").strip():
            tail = {Node.TEXT_NODE: "", Node.PROCESSING_INSTRUCTION_NODE: "-" + node.nodeName}.get(node.nodeType, node.nodeName)
            yield "-".join(above) + tail, node.nodeValue.strip()

    rng = random.Random(3)

    def element(depth):
        name = rng.choice(["a", "b", "x:c", "é"])
        attrs = "".join(f" {k}={q}v&lt;{i}'{q}".replace("''", "'") if q == '"' else f" {k} = 'w{i}'" for i, (k, q) in enumerate(zip(rng.sample(["i", "j", "k-l"], rng.randint(0, 2)), ['"', "'"])))
        parts = [rng.choice(["t", " ", "&amp;&#65;", "<!-- n -->", "<![CDATA[ <raw> ]]>", "<?go now?>", "\n", "é"]) for _ in range(rng.randint(0, 3))]
        parts += [element(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)]
        rng.shuffle(parts)
        return f"<{name}{attrs}>{''.join(parts)}</{name} >" if parts else f"<{name}{attrs}/>"

    texts = [f"<r xmlns:x='u'>{element(3)}{element(2)}</r>" for _ in range(60)]
    texts += [t[: rng.randint(1, len(t) - 1)] for t in texts[:30]] + [t.replace("</", "<", 1) for t in texts[:10]]
    texts += ["<a i='1' i='2'/>", "<a><b></a></b>", "<a>&nbsp;</a>", "<a>]]></a>", "<a>&#0;</a>", "<a b=c/>", "<1a/>", "<a><!-- x -- y --></a>", " <a/> ", "<a", "<a/><?xml version='1.0'?>"]
    texts.append("<a>" + "<b><c>1</c></b>" * 3000 + "</a>")
    got = rows(list(enumerate(texts)), "i int, t string").select("i", xml_fields.xml_flatten("t", ["/*"], 99).alias("x")).collect()
    for r in got:
        try:
            want = dict(entries(minidom.parseString(texts[r.i].strip().encode()).documentElement))
        except ExpatError:
            want = None
        assert r.x == want, texts[r.i]


def test_xml_values(rows):
    df = xml_fields.xml_values("t", {"b": "/a/b/text()", "i": "/a/@i"})(rows([("<a i='1'><b>x</b></a>",), ("<a><b>",), ("",)], "t string"))
    assert [(r.b, r.i) for r in df.collect()] == [("x", "1"), (None, None), (None, None)]


@pytest.mark.parametrize(
    "op, operands, expected",
    [
        ("+", ["a", "b"], "9"), ("-", ["a", "b"], "5"), ("/", ["n", "b"], "-3"), ("%", ["n", "b"], "-1"), ("/", ["a", "z"], None),
        ("%", ["a", "z"], None), ("*", [2147483647, 2], "-2"), ("+", ["a", "missing"], None), ("+", ["a", "missing", 1], "8"),
        ("+", ["a", "text"], None), ("./", ["a", "b"], "3.5"), ("./", ["a", "z"], "Infinity"), ("./", ["z", "z"], "NaN"),
        (".%", ["n", "b"], "-1.0"), (".+", ["a", 0.5, 1], "8.5"), ("-", [-2147483648, 1], "2147483647"), ("/", [-2147483648, -1], "-2147483648"),
    ],
)
def test_arithmetic(rows, op, operands, expected):
    df = rows([("7", "2", "-7", "0", "x")], "a string, b string, n string, z string, text string")
    assert mutate.arithmetic("out", op, operands)(df).first().out == expected


def test_predicates_and_guards(rows):
    df = rows([(None,), ("",), ("ab",), ("a\nb",), ("12",)], "t string")

    def hits(c):
        return [bool(r.x) for r in df.select(c.alias("x")).collect()]

    assert hits(p.exist("t")) == [False, True, True, True, True]
    assert hits(p.equal("t", "")) == [True, True, False, False, False]
    assert hits(p.match("t", "a|ab")) == [False, False, True, False, False]
    assert hits(p.not_match("t", "ab")) == [True, True, False, True, True]
    assert hits(p.find("t", "b$")) == [False, False, True, True, False]
    assert hits(p.math("t", "<=", 12)) == [False, False, False, False, True]
    step = require(mutate.insert("mark", "y"), p.find("t", "a"), p.not_equal("t", "ab"))
    assert [r.mark for r in step(df).collect()] == [None, None, None, "y", None]


def test_route_prefers_token_then_type(rows):
    df = rows([("u1", "a"), ("u1", "b"), ("u2", "a"), ("u2", None)], "token string, type string")
    table = {"*": {"a": [mutate.insert("r", "any-a")], "*": [mutate.insert("r", "any")]}, "u1": {"a": [mutate.insert("r", "own-a")]}}
    assert [r.r for r in route(df, table).collect()] == ["own-a", "any", "any-a", "any"]


def test_later_rule_of_the_same_tag_decides(rows):
    rules = [("t", "a.*", "tag", "info"), ("t", ".*b", "tag", "error")]
    df = rows([("ab",), ("ax",), ("x",), (None,)], "t string")
    assert [r.tag for r in anomaly.regex_anomalies(rules)(df).collect()] == ["error", "info", None, None]


def test_xml_with_anything_beside_its_root_is_malformed(rows):
    from logloom.operators import xml_fields

    texts = ["<a/>junk", "<a/><b/>", "<a>1</a> tail <", "<a>1</a>", '<?xml version="1.0"?>\n<a>1</a>', "<a>&lt;&#65;</a>", "<a>&no;</a>", "<!DOCTYPE a [<!ENTITY e 'x'>]><a>&e;</a>", "", None, "<x:a>1</x:a>", "</a>", "<a>1</a><!-- c -->"]
    df = rows([(i, t) for i, t in enumerate(texts)], "i int, doc string")
    got = {r.i: r.v for r in xml_fields.xml_values("doc", {"v": "/a/text()"})(df).collect()}
    assert [got[i] for i in (3, 4, 5, 12)] == ["1", "1", "<A", "1"]
    assert [got[i] for i in (0, 1, 2, 6, 7, 8, 9, 11)] == [None] * 8  # a prefix that is not declared is read by its local name


def test_the_last_of_repeated_json_keys_wins(rows):
    from logloom.operators import json_fields

    df = rows([('{"a":1,"b":{"c":1,"c":2},"a":3}',)], "doc string")
    assert dict(df.select(json_fields.flatten(F.col("doc"), ["$"], 3).alias("m")).first().m) == {"a": "3", "c": "2"}


def test_a_text_that_lacks_signs_of_the_format_is_not_parsed(rows):
    """Only offsets with a colon reach the second reading, and the result is that of parsing always."""
    from logloom.functions.dates import _marks, _tokens, parse_first
    from logloom.operators.mapping import DATE_FORMATS

    assert _marks(_tokens("dd/MMM/yyyy:HH:mm:ss Z")) == [" ", "/", ":"] and _marks(_tokens("yyyy[-MM]")) == []
    texts = ["10/Oct/2000:13:55:36 -0700", "10/Oct/2000:13:55:36 -07:00", "Tue Oct 10 13:55:36 2000", "2000/10/10 13:55:36", "971211336000",
             "2000-10-10T13:55:36.123Z", "2000-10-10T13:55:36.123+02:00", "2000-10-10t13:55:36.123+0200", "10/Oct/2000", "", None]
    df = rows([(i, t) for i, t in enumerate(texts)], "i int, t string")
    millis = parse_first(F.col("t"), [(f,) for f in DATE_FORMATS])
    got = [r.m for r in df.select("i", millis.alias("m")).orderBy("i").collect()]
    zone = 7 * 3600 * 1000
    at = 971186136000
    assert got == [at + zone, at + zone, at, at, 971211336000, at + 123, at + 123 - 7200000, at + 123 - 7200000, None, None, None]
    plan = df.select(millis.alias("m"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(t#" in plan and "RLIKE" in plan


def test_a_recursive_step_does_not_describe_what_it_passes(rows):
    df = rows([('{"a":{"k":1},"b":[null,{"k":{"k":2}},[]],"k":null}',), ("[[[[{\"k\":5}]]]]",), ("3",)], "t string")
    found = json_fields._walk(json_fields.parsed(F.col("t")), json_fields._tokens("$..['k']"))
    got = df.select(F.transform(found, lambda v: F.to_json(v)).alias("x"))
    assert [r.x for r in got.collect()] == [["null", "1", '{"k":2}', "2"], ["5"], []]
    assert "schemaOfVariant" not in got._jdf.queryExecution().optimizedPlan().toString()
