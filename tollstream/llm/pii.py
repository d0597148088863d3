"""Personal data replaced by keyed surrogates of the same kind and look.

Detected: e-mail addresses, secrets (keys and long hexadecimal tokens), IPv4
addresses, card numbers, phone numbers, national ids (3-2-4 digits), and
person names (behind a title, or a known given name before a surname).

The same value gets the same surrogate everywhere, in whatever format it is
written (its normal form decides); different values get different ones:

* Numbers go through a keyed Feistel permutation of their digits, put back
  into the digit places of the original, so format and length stay and no two
  numbers of a kind and length can meet. Card numbers keep whether their check
  digit is right, phone numbers the first digit of a country code. IPv4
  addresses of single hosts stay such.
* E-mail addresses, secrets and names are drawn by a keyed hash: an address
  under a reserved domain, characters of the same classes, a given name of
  the same gender and script with a surname of that script.
* A surrogate may meet another's, or be a real value of the corpus (somebody
  else's number). So the distinct values of the corpus, of every kind, are
  counted by their surrogate; where several meet, or it is itself a value of
  the corpus, all but the first are drawn again until none do. The draws' numbers (0 for nearly all)
  are what a text's surrogates depend on besides its own values.

Within a text, a title with a surname and a surname alone follow the first
full name with that surname: they get the surname of its surrogate. The full
name may come later in the text. A surname behind a title in a text without
the full name is a value of its own; a surname alone is not found there.

Everything is column expressions. Texts are read once to find the values and
once to replace them; the check shuffles distinct values, not texts, and
texts are joined with redrawn values only if there are any.

Defined cases: null texts stay null; texts without personal data stay as they
are, to the character; null ids, repeated rows and other columns don't matter;
``replace`` keeps all columns and replaces one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import let, stage, table

# Given names by script and gender.
GIVEN = {
    ("latin", "f"): "Anna Maria Elena Julia Laura Sophie Clara Emma Nina Sarah Alice Irene Marta Paula Helen Lucy "
                    "Rosa Teresa Mary Jane Carol Diana Susan Karen".split(),
    ("latin", "m"): "John Peter Paul Thomas David Martin Robert Daniel Michael James Henry George Carlos Luis Pedro "
                    "Jorge Hans Karl Stefan Pierre Jean Louis Marco Simon".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Вера Нина Дарья Юлия".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Андрей Дмитрий Алексей Николай Михаил Павел Олег Юрий Борис".split(),
}
# Titles that a name follows, by gender.
TITLES = {"f": "Mrs Ms Miss Frau Mme Madame Sra Señora".split(),
          "m": "Mr Herr Monsieur Señor Sr".split(),
          "": "Dr Prof".split()}
# Syllables that surnames are drawn from, 16 a script.
SYLLABLES = {"latin": "ba del for gar hol ker lin mon nor per ros sal ten val wen zor".split(),
             "cyrillic": "ба вер гор дан жур зол кар лом мир нов пет рус сам тол фед шал".split()}

_UP = r"\p{Lu}[\p{Ll}]+"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_ALL_GIVEN = "|".join(n for names in GIVEN.values() for n in names)
_ALL_TITLES = "|".join(t for ts in TITLES.values() for t in ts)
_CAPITAL = "[" + "".join(sorted({n[0] for n in f"{_ALL_GIVEN}|{_ALL_TITLES}".split("|")})) + "]"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|AKIA[0-9A-Z]{16}|ghp_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,64})(?![0-9A-Za-z])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "id": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3}[ .-]\d{3,4}(?!\d)"
             r"|(?<![\d+])\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)|(?<![\d+])\+\d{9,15}(?!\d)"
             r"|(?<![\d.-])(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
             r"|(?<![\d.-])(?<!\d )(?:1[ .-])?[2-9]\d{2} \d{3}[ -]\d{4}(?![\d-]| \d)",
    "card": r"(?<![\d.])(?:\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d|\.\d)",
    "name": rf"(?={_CAPITAL})(?<!\p{{L}})(?:(?:{_ALL_TITLES})\.? {_UP}(?:[ -]{_UP})?|(?:{_ALL_GIVEN}) {_UP})(?!\p{{L}})",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Texts that can hold any of them, found much faster.
MAY = rf"[\d@]|[A-Fa-f]{{32}}|sk-|ghp_|AKIA|(?={_CAPITAL})(?<!\p{{L}})(?:{_ALL_TITLES}|{_ALL_GIVEN})(?!\p{{L}})"
ROUNDS = 8


def _int(hexdigits: Column) -> Column:
    """Up to 15 hex digits as a long."""
    return F.conv(hexdigits, 16, 10).cast("long")


def _mac(key: str, *parts: Column) -> Column:
    """256 keyed bits as hex."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts], F.lit(key)).cast("binary"), 256)


def kind_of(value: Column) -> Column:
    """The kind of a detected value."""
    out = F.lit("name")
    for kind in ("card", "phone", "id", "ip", "secret", "email"):
        out = F.when(value.rlike(rf"\A(?:{PATTERNS[kind]})\z"), kind).otherwise(out)
    return out


def without_title(name: Column) -> Column:
    return F.regexp_replace(name, rf"\A(?:{_ALL_TITLES})\.? ", "")


def people(found: Column) -> Column:
    """The full names, without titles, among a text's values."""
    return F.array_distinct(F.filter(F.transform(found, without_title), lambda v: v.rlike(rf"\A{_UP} {_UP}\z")))


def with_surnames(names: Column) -> Column:
    """The pattern of all values and of the surnames of full names."""
    last = F.array_distinct(F.transform(names, lambda n: F.regexp_extract(n, r"\p{L}+\z", 0)))
    return F.concat(F.lit(ANY + r"|(?<!\p{L})(?:"), F.array_join(last, "|"), F.lit(r")(?!\p{L})"))


def normal_form(kind: Column, value: Column) -> Column:
    """What makes two spellings one value."""
    digits = F.regexp_replace(value, r"\D", "")
    bare = without_title(value)
    return (F.when(kind.isin("card", "phone", "id"), digits)
            .when(kind == "name", F.lower(bare))
            .when(kind == "secret", F.when(value.rlike(r"\A[0-9A-Fa-f]+\z"), F.lower(value)).otherwise(value))
            .otherwise(F.lower(value)))


def permuted_digits(digits: Column, key: str, kind: Column, again: Column | None = None) -> Column:
    """Keyed permutation of the digit strings of a length (2 to 19), another
    one for each draw number: a Feistel network over the two halves."""
    again = F.lit(0) if again is None else again
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")

    def power(width: Column) -> Column:
        return F.pow(F.lit(10.0), width).cast("long")

    def run(d: Column) -> Column:
        begin = F.struct(F.substring(d, F.lit(1), left).cast("long").alias("a"),
                         F.substring(d, left + 1, n - left).cast("long").alias("b"))

        def step(s: Column, i: Column) -> Column:
            width = F.when(i % 2 == 0, left).otherwise(n - left)
            draw = _int(F.substring(_mac(key, kind, n, i, s["b"], again), 1, 14))
            return F.struct(s["b"].alias("a"), F.pmod(s["a"] + F.pmod(draw, power(width)), power(width)).alias("b"))

        end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), begin, step)
        return let(end, lambda s: F.concat(F.lpad(s["a"].cast("string"), left, F.lit("0")),
                                           F.lpad(s["b"].cast("string"), n - left, F.lit("0"))))

    return let(digits, run)


def luhn(digits: Column) -> Column:
    """The check digit that belongs behind the digits."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: let(
        d.cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: F.floor(x / 10) + x % 10))
    total = F.aggregate(F.filter(values, lambda x: x.isNotNull()), F.lit(0).cast("long"), lambda s, x: s + x)
    return (F.lit(10) - total % 10) % 10


def _into_places(template: Column, digits: Column) -> Column:
    """The digits in the template's digit places."""
    parts = F.split(template, r"\d", -1)
    return F.concat_ws("", F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(
        F.concat(F.substring(digits, i, F.lit(1)), p))))


def _number(value: Column, kind: Column, key: str, again: Column) -> Column:
    return _into_places(value, permuted_digits(F.regexp_replace(value, r"\D", ""), key, kind, again))


def _phone(value: Column, key: str, again: Column) -> Column:
    """The first digit of a country code stays: none begins with 0, and one
    written without a gap has no other end."""
    code = F.regexp_extract(value, r"\A(?:\+\d)?", 0)
    rest = F.substring(value, F.length(code) + 1, F.lit(1 << 20))
    return F.concat(code, _number(rest, F.lit("phone"), key, again))


def _card(value: Column, key: str, again: Column) -> Column:
    def new(d: Column) -> Column:
        body = F.substring(d, F.lit(1), F.length(d) - 1)
        slip = F.pmod(F.substring(d, F.length(d), F.lit(1)).cast("int") - luhn(body), F.lit(10))
        return let(permuted_digits(body, key, F.lit("card"), again),
                   lambda p: F.concat(p, F.pmod(luhn(p) + slip, F.lit(10)).cast("string")))

    return _into_places(value, let(F.regexp_replace(value, r"\D", ""), new))


# First octets of addresses of single hosts: 1 to 223 without 127.
_HOSTS = 222


def _ip(value: Column, key: str, again: Column) -> Column:
    """A permutation: the last 24 bits by a Feistel network over two halves
    of 12; the first octet moves among those of single hosts by a keyed step
    that depends on the others (any other first octet stays)."""
    def run(o: Column) -> Column:
        low = o[1] * 65536 + o[2] * 256 + o[3]
        begin = F.struct(F.floor(low / 4096).alias("a"), (low % 4096).alias("b"))
        end = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), begin, lambda s, i: F.struct(
            s["b"].alias("a"),
            F.pmod(s["a"] + _int(F.substring(_mac(key, F.lit("ip"), i, s["b"], again), 1, 4)), F.lit(4096).cast("long")).alias("b")))
        step = _int(F.substring(_mac(key, F.lit("ip"), low, again), 1, 8))
        place = F.pmod(o[0] - 1 - (o[0] > 127).cast("int") + step, F.lit(_HOSTS).cast("long"))
        host = (o[0] >= 1) & (o[0] <= 223) & (o[0] != 127)
        first = F.when(host, place + 1 + (place >= 126).cast("int")).otherwise(o[0])
        return let(end, lambda s: let(s["a"] * 4096 + s["b"], lambda x: F.concat_ws(
            ".", first.cast("string"), F.floor(x / 65536).cast("string"), F.floor(x % 65536 / 256).cast("string"),
            (x % 256).cast("string"))))

    return let(F.transform(F.split(value, r"\."), lambda x: x.cast("long")), run)


def _cased(value: Column, made: Column) -> Column:
    """Upper case where the original has no lower-case letter."""
    return F.when((F.upper(value) == value) & (F.lower(value) != value), F.upper(made)).otherwise(made)


def _email(value: Column, draw: Column) -> Column:
    names = F.array(*[F.lit(x.lower()) for x in GIVEN["latin", "f"][:8] + GIVEN["latin", "m"][:8]])
    tail = F.element_at(F.array(F.lit("com"), F.lit("org"), F.lit("net")), (_int(F.substring(draw, 1, 4)) % 3 + 1).cast("int"))
    local = F.concat(F.get(names, (_int(F.substring(draw, 5, 4)) % 16).cast("int")), F.lit("."), F.substring(draw, 9, 10))
    return _cased(value, F.concat(local, F.lit("@m"), F.substring(draw, 19, 3), F.lit(".example."), tail))


def _secret(value: Column, draw: Column) -> Column:
    """Characters of the same classes behind the same known prefix."""
    prefix = F.regexp_extract(value, r"\A(?:AKIA|ghp_|sk-)?", 0)
    stream = F.concat(draw, *[F.sha2(F.concat(draw, F.lit(str(k))).cast("binary"), 256) for k in range(3)])
    is_hex = value.rlike(r"\A[0-9A-Fa-f]+\z")
    upper = value.rlike(r"\A[^a-z]+\z")
    width = F.length(value) - F.length(prefix)
    plain = F.substring(stream, F.lit(1), width)
    letters = F.when(upper, F.upper(F.translate(plain, "0123456789abcdef", "ghjkmnpqrstvwxyz"))).otherwise(
        F.translate(plain, "0123456789abcdef", "gHjKmNpQrStVwXyZ"))
    made = F.when(is_hex, F.when(upper, F.upper(plain)).otherwise(plain)).otherwise(letters)
    return F.concat(prefix, made)


def _name(value: Column, draw: Column, again: Column) -> Column:
    title = F.regexp_extract(value, rf"\A(?:(?:{_ALL_TITLES})\.? )?", 0)
    rest = F.substring(value, F.length(title) + 1, F.lit(1 << 20))
    first = F.regexp_extract(rest, r"\A\p{L}+", 0)
    cyrillic = rest.rlike(r"\p{IsCyrillic}")
    gender = F.when(title.rlike(rf"\A(?:{'|'.join(TITLES['f'])})\b"), "f").when(
        title.rlike(rf"\A(?:{'|'.join(TITLES['m'])})\b"), "m")
    for g in "fm":
        own = [n for (_, x), names in GIVEN.items() if x == g for n in names]
        gender = F.coalesce(gender, F.when(first.isin(own), g))

    def pick(values: list[str], at: int) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), (_int(F.substring(draw, at, 6)) % len(values)).cast("int"))

    given = None
    for (script, g), names in GIVEN.items():
        test = (cyrillic if script == "cyrillic" else ~cyrillic) & (
            F.coalesce(gender, F.when(_int(F.substring(draw, 1, 2)) % 2 == 0, "f").otherwise("m")) == g)
        given = F.when(test, pick(names, 3)) if given is None else given.when(test, pick(names, 3))

    def surname(script: str) -> Column:
        # 4 syllables, and one more for every 8 draws
        s = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        n = F.lit(4) + F.floor(again / 8).cast("int")
        return F.initcap(F.concat_ws("", F.transform(F.sequence(F.lit(1), n), lambda i: F.get(
            s, _int(F.substring(draw, i + 10, F.lit(1))).cast("int")))))

    last = F.when(cyrillic, surname("cyrillic")).otherwise(surname("latin"))
    known_first = first.isin([n for names in GIVEN.values() for n in names])
    two = rest.rlike(r"[ -]")
    return F.concat(title, F.when(two | known_first, F.concat(given, F.lit(" "), last)).otherwise(last))


def surrogate(value: Column, key: str, again: Column) -> Column:
    """The replacement of a detected value at draw number ``again``."""
    def of(v: Column) -> Column:
        def by_kind(k: Column) -> Column:
            draw = _mac(key, k, normal_form(k, v), again)
            return (F.when(k == "card", _card(v, key, again)).when(k == "phone", _phone(v, key, again))
                    .when(k == "id", _number(v, k, key, again)).when(k == "ip", _ip(v, key, again))
                    .otherwise(let(draw, lambda d: F.when(k == "email", _email(v, d)).when(k == "secret", _secret(v, d))
                                   .otherwise(_name(v, d, again)))))

        return let(kind_of(v), by_kind)

    return let(value, of)


def _values(found: DataFrame) -> DataFrame:
    """The corpus' distinct values: kind, normal, value (one spelling)."""
    values = found.select(F.explode("found").alias("value"))
    values = values.select(kind_of(F.col("value")).alias("kind"), "value")
    return (values.select("kind", normal_form(F.col("kind"), F.col("value")).alias("normal"), "value")
            .groupBy("kind", "normal").agg(F.min("value").alias("value")))


def redrawn(found: DataFrame, key: str) -> DataFrame:
    """kind, normal and draw number of the values that must not use draw 0,
    because their surrogate met another's or a value of the corpus."""
    values = stage(_values(found).withColumn("again", F.lit(0)), "values")
    real = values.select("kind", F.col("normal").alias("made"), F.lit(1).alias("real"))
    while True:
        made = values.withColumn("made", normal_form(F.col("kind"), surrogate(F.col("value"), key, F.col("again"))))
        first = Window.partitionBy("kind", "made").orderBy("again", "normal")
        clash = (made.withColumn("place", F.row_number().over(first)).join(real, ["kind", "made"], "left")
                 .withColumn("clash", (F.col("place") > 1) | F.col("real").isNotNull()))
        clash = stage(clash.select("kind", "normal", "value", "again", "clash"), "draws")
        if clash.where("clash").isEmpty():
            return values.where("again > 0").select("kind", "normal", "again")
        values = stage(clash.select("kind", "normal", "value",
                                    (F.col("again") + F.col("clash").cast("int")).alias("again")), "values")


def replace(docs: DataFrame, key: str, column: str = "text", counted: str | None = "n_replaced") -> DataFrame:
    """The documents, all columns, with surrogates in ``column``; ``counted``
    names a column for the number of replaced values."""
    text = F.col(column).cast("string")
    hits = F.when(text.rlike(MAY), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), text.alias("raw"), hits.alias("found"))
    rows = rows.withColumn("people", people(F.col("found")))
    linked = F.size("people") > 0
    rows = rows.withColumn("pattern", F.when(linked, with_surnames(F.col("people"))))
    rows = rows.withColumn("found", F.when(linked, F.regexp_extract_all("raw", F.col("pattern"), F.lit(0))).otherwise(
        F.col("found")))
    again = redrawn(rows.select("found").where(F.size("found") > 0), key)
    if again.isEmpty():
        rows = rows.withColumn("again", F.lit(None).cast("map<string,int>"))
    else:
        # per text that has such a value: normal form -> draw number
        rows = rows.withColumn("text_key", F.md5(F.col("raw").cast("binary")))
        keyed = rows.where(F.size("found") > 0).select("text_key", "found").distinct()
        keyed = keyed.select("text_key", F.explode(F.array_distinct("found")).alias("value"))
        keyed = keyed.select("text_key", kind_of(F.col("value")).alias("kind"), "value").select(
            "text_key", "kind", normal_form(F.col("kind"), F.col("value")).alias("normal"))
        draws = (keyed.distinct().join(again, ["kind", "normal"])
                 .groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct(
                     F.concat_ws("/", "kind", "normal"), "again"))).alias("again")))
        rows = rows.join(draws, "text_key", "left")

    def number(v: Column) -> Column:
        return let(kind_of(v), lambda k: F.coalesce(
            F.try_element_at(F.col("again"), F.concat_ws("/", k, normal_form(k, v))), F.lit(0)))

    def replacement(v: Column) -> Column:
        bare = without_title(v)
        full = F.when(F.size("people") > 0, F.get(F.filter("people", lambda n: n.endswith(F.concat(F.lit(" "), bare))), F.lit(0)))

        def of(f: Column) -> Column:
            made = let(F.coalesce(f, v), lambda t: let(number(t), lambda a: surrogate(t, key, a)))
            return F.when(f.isNull(), made).otherwise(F.concat(
                F.substring(v, F.lit(1), F.length(v) - F.length(bare)), F.regexp_extract(made, r"\p{L}+\z", 0)))

        return let(full, of)

    gaps = F.when(F.col("pattern").isNull(), F.split(F.col("raw"), ANY, -1)).otherwise(
        F.split(F.col("raw"), F.col("pattern"), -1))
    made = let(gaps, lambda g: F.concat(g[0], F.concat_ws("", F.transform(
        F.col("found"), lambda v, i: F.concat(replacement(v), F.get(g, i + 1))))))
    new = F.when(F.size("found") > 0, made).otherwise(F.col("raw"))
    out = [new.alias(c) if c == column else F.col("row")[c].alias(c) for c in docs.columns if c != counted]
    if counted:
        out.append(F.coalesce(F.greatest(F.size("found"), F.lit(0)), F.lit(0)).cast("long").alias(counted))
    return rows.select(*out)


KEY = "surrogates/1"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in its text."""
    out = replace(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)
    return out.select("doc_id", "text", "n_replaced")
