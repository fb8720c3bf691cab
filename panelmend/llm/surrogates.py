"""PII surrogates: keyed replacements of the same type, gender, script and format.

Only DataFrame functions. Texts are searched for e-mail addresses, phone numbers, IPv4 addresses,
card, social security and bank account numbers, and names behind a title. Each entity is normalized
(case, separators, country prefix), and its replacement is drawn from a keyed digest of kind and
normal form. So one entity has one replacement everywhere, however it is written; the writing itself
(separators, case, length, title, first digit and checksum of a card) is kept.

A person is a surname, a first name and a gender. The surname's replacement follows from the surname,
the first name's from the whole name, so people of one surname share the new surname and differ in
the first name. A bare surname gets the surname's replacement: it names as many people as before.
Phone numbers are those of 3-3-4 digits and international ones (``+`` or ``00``, 8 to 15 digits); the
country code is kept. National numbers in other groups are not told from other numbers.

Two checks keep entities apart: no two entities of a kind may share a replacement, and none may be
replaced by an entity that occurs. Whoever fails draws again with a higher attempt, until none does.
Only entities that had to draw again are joined to the texts; the others follow from their digest.

Defined cases: null and empty texts stay as they are with no entities; repeated rows are replaced
alike; an empty table gives an empty result; other columns are ignored; whole texts of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend.llm.common import Scratch

KEY = "surrogate-key-1"

#: Titles by gender; fixed values of ordinary language.
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "Mme", "Mlle", "г-жа", "κα"]
MALE = ["Mr", "Herr", "Señor", "Monsieur", "г-н", "κος"]
FIRST = {
    ("latin", "f"): ["Anna", "Clara", "Elena", "Julia", "Laura", "Maria", "Nora", "Sofia"],
    ("latin", "m"): ["Adam", "David", "Felix", "Jonas", "Lucas", "Martin", "Paul", "Simon"],
    ("cyrillic", "f"): ["Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Софья"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Сергей"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ζωή", "Ιωάννα", "Κατερίνα", "Μαρία", "Νίκη", "Σοφία"],
    ("greek", "m"): ["Άρης", "Γιάννης", "Ηλίας", "Κώστας", "Λουκάς", "Μάρκος", "Νίκος", "Πέτρος"],
}
SYLLABLES = {
    "latin": "ba de fi go ku la me ni po ra se ti va wi zo ha".split(),
    "cyrillic": "ба де фи го ку ла ме ни по ра се ти ва ви зо ха".split(),
    "greek": "βα δε φι γο κου λα με νι πο ρα σε τι ζα θι ξο χα".split(),
}

_WORD = r"\p{Lu}[\p{L}'-]*\p{Ll}"
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    # 3-3-4 digits, or an international form of 8 to 15 digits in any groups
    "phone": (r"(?<![\w.+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
              r"(?![0-9])|(?<![\w.+])(?:\+|00(?=[1-9][0-9]{0,2}[ ./(-]))[1-9](?:[ ./-]{0,2}\(?[0-9]\)?){7,14}"
              r"(?![0-9])"),
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "card": r"(?<![\w.])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "ip": (r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}"
           r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?!\.?[0-9A-Za-z])"),
    "name": (r"(?<!\w)(?:" + "|".join(FEMALE + MALE) + rf")\.?\x20{_WORD}+(?:\x20{_WORD}+)?"),
}
#: Country codes by the world's numbering plan: what starts no shorter one has three digits.
COUNTRY = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
#: Every entity has one of these, and most texts none.
HINT = r"@|[0-9]|" + "|".join(rf"{t}\.?\x20\p{{Lu}}" for t in FEMALE + MALE)
PATTERN = "|".join(KINDS.values())


def kind_of(surface: Column) -> Column:
    """The kind of a match, by the order of the pattern."""
    out = F.when(surface.contains("@"), "email")
    for kind in ("iban", "phone", "ssn", "ip", "card"):
        out = out.when(surface.rlike(f"^(?:{KINDS[kind]})$"), kind)
    return out.otherwise("name")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _surname(c: Column) -> Column:
    return F.regexp_extract(c, r"([^\x20]+)$", 1)


def _first(c: Column) -> Column:
    """The first name in lower case, empty behind a title alone."""
    return F.lower(F.regexp_extract(c, r"\x20([^\x20]+)\x20[^\x20]+$", 1))


def _female(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, r"^([^\x20]+)", 1), r"\.$", "").isin(FEMALE)


def _international(surface: Column) -> Column:
    return surface.rlike(r"^(?:\+|00)")


def _abroad(surface: Column) -> Column:
    """Digits of an international number from its country code on, without a trunk zero."""
    return F.regexp_replace(F.regexp_replace(surface, r"^00|\(0\)", ""), "[^0-9]", "")


def _phone_norm(surface: Column) -> Column:
    digits = _abroad(surface)
    return (F.when(~_international(surface) | (F.length(digits) == 11) & digits.startswith("1"),
                   F.substring(_digits(surface), -10, 10))
            # ten digits alone are a national number
            .when(F.length(digits) == 10, F.concat(F.lit("+"), digits)).otherwise(digits))


def normal(surface: Column, kind: Column) -> Column:
    """What all writings of one entity have in common."""
    digits = _digits(surface)
    return (F.when(kind == "email", F.lower(surface))
            .when(kind == "phone", _phone_norm(surface))
            .when(kind == "iban", F.replace(surface, F.lit(" "), F.lit("")))
            .when(kind == "ip", surface)
            .when(kind == "name", F.lower(_surname(surface)))
            .otherwise(digits))


def _draw(stream: Column, at: Column, n: int) -> Column:
    """A number below n, by place in the stream of hexadecimal digits."""
    return (F.conv(F.substr(stream, (at * 4) % 120 + 1, F.lit(4)), 16, 10).cast("int") % n).cast("int")


def _luhn(digits: Column) -> Column:
    """The checksum of a card number, 0 if it is valid."""
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0),
                       lambda a, x: a + x) % 10


def _script(surface: Column) -> Column:
    name = _surname(surface)
    return (F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"\p{IsGreek}"), "greek")
            .otherwise("latin"))


def _listed(values: list[str], stream: Column, at: int) -> Column:
    return F.get(F.array(*map(F.lit, values)), _draw(stream, F.lit(at), len(values)))


def first_name(female: Column, script: Column, norm: Column, first: Column, attempt: Column,
               key: str = KEY) -> Column:
    """The replacement of a person's first name: one of its gender, from the second draw on doubled."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit("first"), norm, first, attempt.cast("string")), 256)
    out = F.lit(None).cast("string")
    for s, parts in SYLLABLES.items():
        one = F.when(female, _listed(FIRST[s, "f"], seed, 9)).otherwise(_listed(FIRST[s, "m"], seed, 9))
        two = F.initcap(F.concat(*[_listed(parts, seed, i) for i in range(5)]))
        out = F.when(script == s, F.when(attempt > 0, F.concat(one, F.lit("-"), two)).otherwise(one)).otherwise(out)
    return out


def _name(surface: Column, stream: Column, norm: Column, first_attempt: Column, key: str) -> Column:
    """Title as it was, a first name of its gender where there is one, a made-up surname."""
    title = F.regexp_extract(surface, r"^([^\x20]+\x20)", 1)
    script, first = _script(surface), _first(surface)
    last = F.lit(None).cast("string")
    for s, parts in SYLLABLES.items():
        last = F.when(script == s, F.concat(*[_listed(parts, stream, i) for i in range(6)])).otherwise(last)
    new = first_name(_female(surface), script, norm, first, first_attempt, key)
    return F.concat(title, F.when(first != "", F.concat(new, F.lit(" "))).otherwise(""), F.initcap(last))


def surrogate(surface: Column, kind: Column, norm: Column, attempt: Column, key: str = KEY,
              first_attempt: Column | None = None) -> Column:
    """The replacement of one writing of an entity; ``first_attempt`` is that of a first name."""
    first_attempt = F.lit(0) if first_attempt is None else first_attempt
    seed = F.sha2(F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string")), 256)
    stream = F.concat(seed, F.sha2(seed, 256))
    chars = F.split(surface, "")

    def spot(i: Column) -> Column:  # letters and digits from here to the end, so prefixes don't shift
        return F.length(F.regexp_replace(F.substr(surface, i + 1), "[^0-9A-Za-z]", ""))

    def fresh(c: Column, i: Column) -> Column:
        at = spot(i)
        return (F.when(c.rlike("^[0-9]$"), _draw(stream, at, 10).cast("string"))
                .when(c.rlike("^[a-z]$"), F.chr(_draw(stream, at, 26) + 97))
                .when(c.rlike("^[A-Z]$"), F.chr(_draw(stream, at, 26) + 65)).otherwise(c))

    abroad = _abroad(surface)
    national = F.when(_international(surface), F.length(F.regexp_replace(abroad, COUNTRY, ""))).otherwise(10)

    def phone(c: Column, i: Column) -> Column:
        at = spot(i)
        return (F.when(~c.rlike("^[0-9]$") | (at > national), c)
                .when(at == 10, (_draw(stream, at, 8) + 2).cast("string"))
                .otherwise(_draw(stream, at, 10).cast("string")))

    def joined(f) -> Column:
        return F.array_join(F.transform(chars, f), "")

    top = F.regexp_extract(surface, r"(\.[A-Za-z0-9-]+)$", 1)
    email = F.concat(F.substr(joined(fresh), F.lit(1), F.length(surface) - F.length(top)), top)
    iban = F.concat(F.substring(surface, 1, 2), F.substr(joined(fresh), F.lit(3)))
    card = F.concat(F.substring(surface, 1, 1), F.substr(joined(fresh), F.lit(2)))
    body = F.substr(card, F.lit(1), F.length(card) - 1)
    check = F.concat(body, ((10 - _luhn(F.concat(_digits(body), F.lit("0")))) % 10).cast("string"))
    card = F.when(_luhn(_digits(surface)) == 0, check).otherwise(card)
    octets = [(_draw(stream, F.lit(i), 254) + 1).cast("string") for i in range(4)]
    # a form that is nearly full gives way to a wider one: longer local parts, the large private block
    wider = F.floor(attempt / WIDEN).cast("int")
    more = F.when(wider > 0, F.sequence(F.lit(1), wider)).otherwise(F.array().cast("array<int>"))
    email = F.concat(F.array_join(F.transform(
        more, lambda i: F.chr(_draw(stream, i + 17, 26) + 97)), ""), email)
    ip = (F.when(surface.startswith("10.") | surface.startswith("192.168.") & (wider > 0),
                 F.concat_ws(".", F.lit("10"), *octets[1:]))
          .when(surface.startswith("192.168."), F.concat_ws(".", F.lit("192.168"), *octets[2:]))
          .otherwise(F.concat_ws(".", *octets)))
    return (F.when(kind == "email", email).when(kind == "phone", joined(phone))
            .when(kind == "iban", iban).when(kind == "card", card).when(kind == "ip", ip)
            .when(kind == "name", _name(surface, stream, norm, first_attempt, key)).otherwise(joined(fresh)))


#: Draws after which a form is widened, again and again, and after which a draw is kept as it is.
WIDEN, LAST = 3, 60


def attempts(entities: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """``kind, norm, attempt`` of the entities that must not use their first draw.

    ``entities``: one row ``kind, norm, surface`` per entity. After every third draw an entity's form
    gets wider (see :func:`surrogate`), so draws come to an end; only where no form is wider and all
    its replacements are in use can the sixtieth draw be one that occurs.
    """
    now = entities.withColumn("attempt", F.lit(0))
    while True:
        drawn = now.withColumn("new", normal(
            surrogate(F.col("surface"), F.col("kind"), F.col("norm"), F.col("attempt"), key), F.col("kind")))
        drawn = scratch.table(drawn, "drawn")
        # of several with one replacement the first keeps it; a real entity's form is nobody's
        owners = drawn.groupBy("kind", "new").agg(F.min("norm").alias("owner"),
                                                  F.count(F.lit(1)).alias("n"))
        clash = owners.where("n > 1").select("kind", "new", "owner")
        real = drawn.select("kind", F.col("norm").alias("new"), F.lit(None).cast("string").alias("owner"))
        taken = clash.unionByName(real.join(owners.select("kind", "new"), ["kind", "new"], "left_semi"))
        taken = taken.groupBy("kind", "new").agg(F.max(F.col("owner").isNull()).alias("real"),
                                                 F.max("owner").alias("owner"))
        again = (drawn.join(taken, ["kind", "new"])
                 .where((F.col("attempt") < LAST) & (F.col("real") | (F.col("norm") != F.col("owner"))))
                 .select("kind", "norm"))
        again = scratch.table(again, "again")
        if again.isEmpty():
            return drawn.where("attempt > 0").select("kind", "norm", "attempt")
        now = (drawn.join(again.withColumn("more", F.lit(1)), ["kind", "norm"], "left")
               .select("kind", "norm", "surface",
                       (F.col("attempt") + F.coalesce("more", F.lit(0))).alias("attempt")))


def first_attempts(people: DataFrame, scratch: Scratch, key: str = KEY) -> DataFrame:
    """``norm, first, female, first_attempt`` of those who must not use their first draw.

    ``people``: ``norm, first, female, script``, one row per person. No two surnames have one
    replacement, so only first names under one surname can meet.
    """
    now = people.withColumn("first_attempt", F.lit(0))
    while True:
        drawn = scratch.table(now.withColumn("new", first_name(
            F.col("female"), F.col("script"), F.col("norm"), F.col("first"), F.col("first_attempt"), key)), "firsts")
        # the lowest attempt keeps it, so nobody who is settled draws again
        owners = drawn.groupBy("norm", "female", "new").agg(
            F.min(F.struct("first_attempt", "first"))["first"].alias("owner"), F.count(F.lit(1)).alias("n"))
        again = scratch.table(drawn.join(owners.where("n > 1"), ["norm", "female", "new"]).where(
            "first <> owner").select("norm", "female", "first"), "again")
        if again.isEmpty():
            return drawn.where("first_attempt > 0").select("norm", "first", "female", "first_attempt")
        now = (drawn.drop("new").join(again.withColumn("more", F.lit(1)), ["norm", "female", "first"], "left")
               .withColumn("first_attempt", F.col("first_attempt") + F.coalesce("more", F.lit(0))).drop("more"))


def _numbered(found: DataFrame, again: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The hits with a further field from ``again``, 0 where it has no row."""
    if again.isEmpty():
        return found.withColumn("hits", F.transform("hits", lambda e: e.withField(name, F.lit(0))))
    at = (found.select("row", F.posexplode("hits").alias("place", "e"))
          .select("row", "place", *[F.col(f"e.{k}").alias(k) for k in keys]).join(again, keys)
          .groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", name))).alias("numbers")))
    return found.join(at, "row", "left").withColumn("hits", F.transform(
        "hits", lambda e, i: e.withField(name, F.coalesce(
            F.try_element_at("numbers", i), F.lit(0))))).drop("numbers")


def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``doc_id, n_entities``, a number per kind, and ``text`` with surrogates."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select("doc_id", "text")
    hits = F.regexp_extract_all(F.col("text"), F.lit(PATTERN), F.lit(0))
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    marked = rows.withColumn("hits", F.when(hinted, hits))
    has = F.coalesce(F.size("hits") > 0, F.lit(False))

    def entity(s: Column) -> Column:
        kind = kind_of(s)
        name = kind == "name"
        return F.struct(s.alias("surface"), kind.alias("kind"), normal(s, kind).alias("norm"),
                        F.when(name, _first(s)).otherwise("").alias("first"),
                        (name & _female(s)).alias("female"))

    found = scratch.table(marked.where(has).select(
        "doc_id", "text", F.monotonically_increasing_id().alias("row"),
        F.transform("hits", entity).alias("hits")), "found")
    entities = (found.select(F.explode("hits").alias("e")).groupBy("e.kind", "e.norm")
                .agg(F.min("e.surface").alias("surface")))
    again = attempts(entities, scratch, key)
    people = (found.select(F.explode("hits").alias("e")).where("e.first <> ''")
              .groupBy("e.norm", "e.first", "e.female").agg(F.min(_script(F.col("e.surface"))).alias("script")))
    drawn = _numbered(found, again, ["kind", "norm"], "attempt")
    drawn = _numbered(drawn, first_attempts(people, scratch, key), ["norm", "first", "female"], "first_attempt")
    new = F.transform("hits", lambda e: surrogate(
        e["surface"], e["kind"], e["norm"], e["attempt"], key, e["first_attempt"]))
    between = F.split(F.col("text"), PATTERN, -1)
    whole = F.array_join(F.flatten(F.zip_with(
        between, new, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")

    def number(kind: str) -> Column:
        return F.size(F.filter("hits", lambda e: e["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = list(KINDS)
    changed = drawn.select("doc_id", F.size("hits").cast("long").alias("n_entities"),
                           *[number(k) for k in kinds], whole.alias("text"))
    same = marked.where(~has).select(
        "doc_id", F.lit(0).cast("long").alias("n_entities"),
        *[F.lit(0).cast("long").alias(f"n_{k}") for k in kinds], "text")
    return changed.unionByName(same)
