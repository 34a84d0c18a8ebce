"""Surrogates for personal data and secrets.

One pattern finds the entities of a text. Each is cut into parts (an email into local part and domain, a titled name
into given and family name), and every distinct part of the whole corpus gets one keyed surrogate of its kind: digits
stay digits, letters keep case and script, card numbers keep issuer digit and checksum state, names follow the title's
gender. Names, local parts, domains and secrets get one more syllable or letter every four draws, so there are enough for
any number of parts; a surrogate of these that meets another one or a real part is drawn again. Numbers and IPv4 addresses
keep the size of their format, whose whole space may be in use. They go through a keyed permutation of that space
without fixed points: different numbers have different surrogates by construction, no number stays as it is, and no draw
is repeated. Such a surrogate may be a number that stands elsewhere in the corpus; there it is replaced as well. So
different parts stay different and equal parts stay equal everywhere.

Only DataFrame functions are used. Texts without an entity are not shuffled. Defined cases: a null or empty text has no
entity; rows that repeat both doc_id and text are treated alike; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.cols import let
from logloom.llm.common import saved

MALE = "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|господин|Господин"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Señora|Sra|госпожа|Госпожа"
EITHER = "Dr|Prof"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){1,8}"
KEYED = r"""(?i:(?<![\p{L}\p{N}])(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}["']?)"""
SECRET = r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+|sk-[A-Za-z0-9]{20,}+|xox[abprs]-[A-Za-z0-9-]{10,}+)"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
IP = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
#: Phone numbers with a country code; national ones with a trunk zero or in groups of nine digits; ten or eleven plain digits.
COUNTRY = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
ABROAD = r"(?<![\p{L}\p{N}+])(?:\+|00(?=[1-9]\d{0,2}[ .-]))[1-9](?:[ ./-]{0,2}\(?\d\)?){6,14}(?!\d)"
TRUNK = r"(?<![\p{L}\p{N}+.,/:_-])\(?0[1-9](?:\)?[ ./-]?\d){7,10}(?![\d:]|[./-]\d)"
GROUPS = r"(?<![\p{N}+.,/:_-])(?<!\p{N} )(?:[6-9]\d{2}[ -]\d{3}[ -]\d{3}|[689]\d[ .-]\d{3}[ .-]\d{2}[ .-]\d{2}|[6-9]\d{2}[ .-]\d{2}[ .-]\d{2}[ .-]\d{2})(?!\d|[ .:-]\d)"
PLAIN = r"(?<![\p{L}\p{N}+.,_/:#-])(?:1?[2-9]\d{9}|0[1-9]\d{8,9})(?![\p{L}\p{N}]|[.,_-]\d)"
NUMBER = f"{ABROAD}|{TRUNK}|{GROUPS}|{PLAIN}"
HEX = "[0-9A-Fa-f]{1,4}"
IP6 = rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{HEX}:){{7}}{HEX}|(?:{HEX}(?::{HEX}){{0,6}})?::(?:{HEX}(?::{HEX}){{0,6}})?)(?![\p{{L}}\p{{N}}:])"
CARD = r"(?<![\d.])\d(?:[ -]?\d){12,18}(?!\d)"
NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{MALE}|{FEMALE}|{EITHER})\.? \p{{Lu}}[\p{{L}}'-]++(?: \p{{Lu}}[\p{{L}}'-]++)?"
ENTITY = "|".join([EMAIL, KEYED + r"""[^\s"']{6,}+""", SECRET, IBAN, IP6, IP, SSN, PHONE, NUMBER, CARD, NAME])

#: Every entity holds a digit, an at sign or one of these; most texts hold none and are done after a cheap look.
SIGNS, MARKS = "[0-9@]", ["AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox"]
KEYS = ["passw", "pwd", "token", "secret", "api"]

LATIN, CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшэюя"
SYLLABLES = {
    "latin": "ba be bri ca co da del do el fa fer ga gi ha hol is ja jo ka ke la lin lo ma mi mon na ni nor o pa pe ra ri ro sa so ta to va vin wen".split(),
    "cyrillic": "ба бо ва ве га го да де до зе ка ки ко ла ле ли ма ми мо на не но па пе ра ре ри ро са се та то".split(),
}
#: Last syllables of given names by script and gender.
ENDINGS = {
    ("latin", "f"): ["a", "ina", "elle", "ia"],
    ("latin", "m"): ["n", "rd", "us", "rt"],
    ("latin", "n"): ["ly", "ren", "kim", "ris"],
    ("cyrillic", "f"): ["на", "ина", "ья", "ра"],
    ("cyrillic", "m"): ["н", "р", "слав", "мир"],
    ("cyrillic", "n"): ["ша", "ня", "ля", "ся"],
}


def _draw(key: str, i: Column | int, below: int) -> Column:
    """A keyed number in [0, below) for place ``i`` of the surrogate of (kind, canonical, attempt)."""
    place = i if isinstance(i, Column) else F.lit(i)
    digest = F.sha2(F.concat_ws("\u0001", F.lit(key), "kind", "canonical", F.col("attempt").cast("string"), place.cast("string")), 256)
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % below).cast("int")


def _letter(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), n + 1, F.lit(1))


def _by_class(key: str, text: Column, keep: int = 0) -> Column:
    """Each digit and letter replaced by one of its class, letters of other scripts and their marks by Latin ones; the first ``keep`` characters and all signs stay."""

    def one(c: Column, i: Column) -> Column:
        out = F.when(i < keep, c).when(c.rlike(r"^\d$"), _draw(key, i, 10).cast("string"))
        for pattern, alphabet in (("[a-zà-öø-ÿ]", LATIN), ("[A-ZÀ-ÖØ-Þ]", LATIN.upper()), ("[а-яё]", CYRILLIC), ("[А-ЯЁ]", CYRILLIC.upper())):
            out = out.when(c.rlike(f"^{pattern}$"), _letter(alphabet, _draw(key, i, len(alphabet))))
        out = out.when(c.rlike(r"^\p{N}$"), _draw(key, i, 10).cast("string"))
        for pattern, alphabet in ((r"\p{Lu}", LATIN.upper()), (r"[\p{L}\p{M}]", LATIN)):
            out = out.when(c.rlike(f"^{pattern}$"), _letter(alphabet, _draw(key, i, 26)))
        return out.otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _more(pick) -> Column:
    """One more piece of text after every four attempts: ``pick(i)`` for i from 0 on."""
    n = F.expr("int(attempt DIV 4)")
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), pick), "")).otherwise(F.lit(""))


def _luhn(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, b: a + b) % 10


def _name(key: str, script: str, gender: str | None) -> Column:
    parts = F.array(*map(F.lit, SYLLABLES[script]))
    drawn = [F.get(parts, _draw(key, i, len(SYLLABLES[script]))) for i in range(3)]
    more = _more(lambda i: F.get(parts, _draw(key, F.when(i == 0, 3).otherwise(i + 100), len(SYLLABLES[script]))))
    if gender is None:
        return F.concat(*drawn, more)
    ends = ENDINGS[script, gender]
    return F.concat(drawn[0], drawn[1], more, F.get(F.array(*map(F.lit, ends)), _draw(key, 4, len(ends))))


#: Kinds whose surrogates keep the size of the format.
PERMUTED = ("phone", "number", "ssn", "card", "ip", "iban")


def permuted(key: str) -> Column:
    """The surrogate of (kind, canonical) of a kind of :data:`PERMUTED`.

    A value is an array of places, each with a base: digits 10, a first digit 9 (8 at the heads of a phone number in groups),
    letters 26, octets 254; places of base 1 stay, which are leading zeros, the issuer digit of a card, a country, and octets
    0 and 255. Twice every place but one is shifted by a keyed hash of all others; the one that is left is shifted last,
    by at least one. Each shift can be undone as the others are known, so the whole is a permutation of the values with
    the same bases, and its last shift leaves no value as it is.
    """
    kind, c = F.col("kind"), F.col("canonical")
    # the check digit of a card is no place: it follows from the others and the checksum state
    body = F.when(kind == "card", F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)
    values = F.when(kind == "ip", F.split(c, r"\.")).otherwise(F.filter(F.split(body, ""), lambda x: x != ""))
    grouped = c.rlike(r"^[2-9]\d\d[2-9]\d{6}$") & (kind == "phone")
    zeros = F.length(F.regexp_extract(c, "^0*", 0))
    numeric = kind.isin("phone", "number", "ssn")

    def place(x: Column, i: Column) -> Column:
        letter = x.rlike("^[A-Z]$")
        base = (
            F.when(kind == "ip", F.when(x.isin("0", "255"), 1).otherwise(254))
            .when((kind == "iban") & (i < 2) | (kind == "card") & (i == 0), 1)
            .when(grouped & i.isin(0, 3), 8)
            .when(numeric & (i < zeros), 1)
            .when(numeric & (i == zeros), 9)
            .when(letter, 26)
            .otherwise(F.when(x.rlike(r"^\d$"), 10).otherwise(1))
        )
        low = F.when((kind == "ip") & (base == 254), 1).when(base == 8, 2).when(base == 9, 1).when(letter, 65).otherwise(0)
        value = F.when(letter, F.ascii(x)).when(x.rlike(r"^\d+$"), x.try_cast("int")).otherwise(F.ascii(x))
        return F.struct((value - F.when(base == 1, 0).otherwise(low)).alias("v"), base.alias("b"), F.when(base == 1, 0).otherwise(low).alias("low"), x.alias("x"))

    def mixed(places: Column) -> Column:
        last = F.array_position(F.transform(places, lambda p: p["b"] > 1), F.lit(True)).cast("int") - 1
        every = F.sequence(F.lit(0), F.size(places) - 1)
        others = F.filter(every, lambda i: (i != last) & (F.get(places, i)["b"] > 1))
        turns = F.concat(
            F.transform(others, lambda i: F.struct(F.lit(0).alias("turn"), i.alias("at"))),
            F.transform(others, lambda i: F.struct(F.lit(1).alias("turn"), i.alias("at"))),
            F.when(last >= 0, F.array(F.struct(F.lit(2).alias("turn"), last.alias("at")))).otherwise(F.array().cast("array<struct<turn:int,at:int>>")),
        )

        def turn(state: Column, t: Column) -> Column:
            base = F.get(places, t["at"])["b"]
            seen = F.array_join(F.transform(state, lambda v, i: F.when(i == t["at"], "-").otherwise(v.cast("string"))), ",")
            digest = F.sha2(F.concat_ws("\u0001", F.lit(key), kind, t["turn"].cast("string"), t["at"].cast("string"), seen), 256)
            drawn = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
            shift = F.when(t["turn"] == 2, 1 + drawn % (base - 1)).otherwise(drawn % base).cast("int")
            return let(shift, lambda n: F.transform(state, lambda v, i: F.when(i == t["at"], (v + n) % base).otherwise(v)))

        made = F.aggregate(turns, F.transform(places, lambda p: p["v"]), turn)

        def shown(v: Column, i: Column) -> Column:
            p = F.get(places, i)
            n = v + p["low"]
            return F.when(p["b"] == 1, p["x"]).when(p["b"] == 26, F.char(n)).otherwise(n.cast("string"))

        return let(let(made, lambda m: F.transform(m, shown)), lambda a: F.when(kind == "ip", F.array_join(a, ".")).otherwise(F.array_join(a, "")))

    out = let(F.transform(values, place), mixed)
    check = lambda card: F.concat(card, F.pmod(_luhn(c) - _luhn(F.concat(card, F.lit("0"))), F.lit(10)).cast("string"))
    return let(out, lambda v: F.when(kind == "card", check(v)).otherwise(v))


def surrogate(key: str) -> Column:
    """The surrogate of (kind, canonical, attempt) of a kind that has one of any size."""
    c = F.col("canonical")
    longer = _more(lambda i: _letter(LATIN, _draw(key, i + 1000, 26)))
    labels = F.split(c, r"\.")
    host = F.array_join(F.slice(labels, F.lit(1), F.size(labels) - 1), ".")
    out = F.when(F.col("kind") == "local", F.concat(_by_class(key, c), longer))
    out = out.when(F.col("kind") == "domain", F.concat(_by_class(key, host), longer, F.lit(".example")))
    out = out.when(F.col("kind") == "ip6", F.concat(F.lit("2001:db8:"), F.concat_ws(":", *[F.lower(F.hex(_draw(key, i, 65536))) for i in range(6)])))
    out = out.when(F.col("kind") == "secret", F.concat(_by_class(key, c), longer))
    for script in SYLLABLES:
        out = out.when(F.col("kind") == f"family_{script}", _name(key, script, None))
        for gender in "fmn":
            out = out.when(F.col("kind") == f"given_{script}_{gender}", _name(key, script, gender))
    return out.otherwise(_by_class(key, c))


def _part(kind: Column | str, canonical: Column, lead: Column | str, raw: Column) -> Column:
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    return F.struct(lit(kind).alias("kind"), canonical.alias("canonical"), lit(lead).alias("lead"), raw.alias("raw"))


def parts_of(e: Column) -> Column:
    """The parts of an entity: kind, canonical form, fixed text before it, and as written."""
    digits = F.regexp_replace(e, r"\D", "")
    local, domain = F.substring_index(e, "@", 1), F.substring_index(e, "@", -1)
    told = F.regexp_extract(e, f"^{KEYED}", 0)
    value = F.substring(e, F.length(told) + 1, F.length(e))
    title = F.regexp_extract(e, rf"^(?:{MALE}|{FEMALE}|{EITHER})\.? ", 0)
    names = F.split(F.substring(e, F.length(title) + 1, F.length(e)), " ")
    bare = F.regexp_replace(title, r"[. ]", "")
    gender = F.when(bare.isin(MALE.split("|")), "m").when(bare.isin(FEMALE.split("|")), "f").otherwise("n")
    script = lambda n: F.when(n.rlike("[А-Яа-яЁё]"), "cyrillic").otherwise("latin")
    family = lambda n, lead: _part(F.concat(F.lit("family_"), script(n)), F.lower(n), lead, n)
    given = lambda n: _part(F.concat(F.lit("given_"), script(n), F.lit("_"), gender), F.lower(n), title, n)
    out = F.when(told != "", F.array(_part("secret", value, told, value)))
    out = out.when(e.rlike(f"^(?:{SECRET})"), F.array(_part("secret", e, "", e)))
    out = out.when(e.contains("@"), F.array(_part("local", F.lower(local), "", local), _part("domain", F.lower(domain), "@", domain)))
    out = out.when(title != "", F.when(F.size(names) > 1, F.array(given(names[0]), family(names[1], " "))).otherwise(F.array(family(names[0], title))))
    plain = F.array_join(F.transform(F.split(e, r"\."), lambda o: o.try_cast("int").cast("string")), ".")
    out = out.when(e.rlike(f"^{IP}$"), F.array(_part("ip", plain, "", e)))
    out = out.when(e.rlike(f"^{IP6}$"), F.array(_part("ip6", F.lower(e), "", e)))
    out = out.when(e.rlike(f"^{IBAN}$"), F.array(_part("iban", F.replace(e, F.lit(" ")), "", e)))
    out = out.when(e.rlike(f"^{SSN}$"), F.array(_part("ssn", digits, "", e)))
    out = out.when(e.rlike(f"^{PHONE}$"), F.array(_part("phone", F.substring(digits, -10, 10), "", e)))
    out = out.when(e.rlike(rf"^(?:\+1|1)?[2-9]\d{{9}}$"), F.array(_part("phone", F.substring(digits, -10, 10), "", e)))
    abroad = e.rlike(f"^(?:{ABROAD})$")
    # without country code and trunk zero, so both forms of a number are one part
    own = F.regexp_replace(digits, F.when(abroad, F.lit(f"^(?:00)?{COUNTRY}0?")).otherwise(F.lit("^0")), "")
    out = out.when(e.rlike(f"^(?:{NUMBER})$"), F.array(_part("number", own, "", e)))
    return out.otherwise(F.array(_part("card", digits, "", e)))


def rendered(kind: Column, raw: Column, made: Column) -> Column:
    """A surrogate in the format of ``raw``: its signs between the characters, its case."""
    slots = F.split(raw, r"\d")
    digits = F.regexp_replace(raw, r"\D", "")
    full = F.concat(F.substring(digits, F.lit(1), F.length(digits) - F.length(made)), made)
    fill = F.split(full, "")
    numbers = F.concat(slots[0], F.array_join(F.transform(F.slice(slots, F.lit(2), F.size(slots)), lambda s, i: F.concat(F.get(fill, i), s)), ""))
    spaced = F.array_join(F.transform(F.split(raw, ""), lambda c, i: F.when(c == " ", " ").otherwise(F.substring(made, i + 1 - F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), "[^ ]", "")), F.lit(1)))), "")
    cased = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(made)).when(raw.rlike(r"^\p{Lu}"), F.concat(F.upper(F.substring(made, 1, 1)), F.substring(made, F.lit(2), F.length(made)))).otherwise(made)
    return F.when(kind.isin("phone", "number", "card", "ssn"), numbers).when(kind == "iban", spaced).when(kind.isin("ip", "ip6", "secret"), made).otherwise(cased)


def assign(parts: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, made`` for the distinct parts: no two alike; those of any size equal to no real part of their kind.

    The losers of a round of draws (all but the first of those that meet, and those that meet a real or settled part)
    draw again, with a longer surrogate every four rounds; only they are written again.
    """
    all_parts = saved(parts.select("kind", "canonical").distinct(), "parts")
    fixed = F.col("kind").isin(*PERMUTED)
    done = [all_parts.where(fixed).select("kind", "canonical", permuted(key).alias("made"))]
    real = all_parts.where(~fixed)
    taken = real.withColumnRenamed("canonical", "made")
    state, settled = real.withColumn("attempt", F.lit(0)), []
    while True:
        drawn = saved(state.withColumn("made", surrogate(key)), "drawn")
        free = drawn.join(taken, ["kind", "made"], "left_anti")
        for won in settled:
            free = free.join(won, ["kind", "made"], "left_anti")
        won = saved(free.groupBy("kind", "made").agg(F.min("canonical").alias("canonical")).select("kind", "canonical", "made"), "settled")
        settled.append(won)
        state = saved(drawn.join(won, ["kind", "canonical"], "left_anti").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt")), "again")
        if state.isEmpty():
            return reduce(DataFrame.unionByName, done + settled)


def _may_have(text: Column) -> Column:
    """False only for a text without an entity."""
    plain = [text.contains(m) for m in [*MARKS, *f"{MALE}|{FEMALE}|{EITHER}".split("|")]]
    return reduce(lambda a, b: a | b, [*plain, *[F.lower(text).contains(k) for k in KEYS]], text.rlike(SIGNS))


def replace_entities(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, and ``n_entities``."""
    spare = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(*spare)
    has = F.coalesce(_may_have(F.col(text)) & F.col(text).rlike(ENTITY), F.lit(False))
    entities = F.expr(f"regexp_extract_all({_name_of(text)}, {_quoted(ENTITY)}, 0)")  # one pass of the pattern; a text without entity gives no row
    found = rows.where(_may_have(F.col(text))).select("doc_id", F.xxhash64(text).alias("__hash"), F.posexplode(entities).alias("at", "entity"))
    found = found.select("doc_id", "__hash", "at", F.posexplode(parts_of(F.col("entity"))).alias("k", "p")).select("doc_id", "__hash", "at", "k", "p.*")
    found = saved(found, "entities")
    made = found.join(assign(found, key), ["kind", "canonical"])
    piece = F.struct("at", "k", F.concat("lead", rendered(F.col("kind"), F.col("raw"), F.col("made"))).alias("new"))
    new = made.groupBy("doc_id", "__hash").agg(F.array_sort(F.collect_set(piece)).alias("__new"))
    new = new.select(F.col("doc_id").alias("__id"), F.col("__hash").alias("__of"), "__new")

    touched = rows.where(has).join(new, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__of")))
    count = F.element_at("__new", -1)["at"] + 1
    touched = touched.withColumn("n_entities", count.cast("int"))
    # parts of one entity follow each other; text between entities goes before the first part of the next one
    between = F.split(text, ENTITY, -1)
    touched = touched.withColumn("__between", between)
    body = F.array_join(F.transform("__new", lambda p: F.concat(F.when(p["k"] == 0, F.get("__between", p["at"])).otherwise(F.lit("")), p["new"])), "")
    touched = touched.withColumn(text, F.concat(body, F.element_at("__between", -1))).select(*spare, "n_entities")
    return rows.where(~has).withColumn("n_entities", F.lit(0)).select(*spare, "n_entities").unionByName(touched)


def _name_of(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"
