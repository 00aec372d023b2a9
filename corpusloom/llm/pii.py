"""PII: detected entities get keyed, type-consistent surrogates (DataFrame functions only).

An entity's varying part is a row of characters, each one of a class (digit, vowel or consonant of a
script, hexadecimal digit; an octet is one of its range). A Feistel network over
the two halves of that row adds, round by round, what SHA-256 makes of the key, the type and the other half,
each character within its class. That is a permutation of all rows of one pattern of
classes: distinct entities stay distinct, equal ones stay equal everywhere, in any number
of documents, without a table, and a known pair tells nothing about others. Numbers are taken without their
separators and letters without their case, so one number written in two ways keeps one
surrogate, written in the same two ways. What gives a type its form stays: country codes,
separators, "@", top-level domains, card networks, Luhn checks, IBAN checks, the classes of IPv4
addresses (private, loopback, shared, link-local, multicast, public), key prefixes, titles.
Given names known for a gender are exchanged within that gender's list, along one cycle that the key orders;
other names keep their script, case and length.

The form can still make two surrogates meet that come from differently written originals, so
``replace`` checks: the documents are searched once, with what was found and the new text written to the shared folder; there all
entities are aggregated by surrogate, and if any has two originals the corpus is keyed
anew. Equal rows of a hot entity meet in partial sums.

Defined cases: null text stays null with no entities; empty text stays empty; texts are
read whole, and the work on an entity grows with its length; repeated rows get equal
results; an empty table gives no rows; extra columns are kept by ``replace`` as they are, whatever their names
(but for the column of entities, which it replaces). Cards and IBANs without a valid check stay as they are.
"""

from __future__ import annotations

import hashlib
import hmac
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tables import aside, let, shared_dir

# The forms of entities, in order of precedence.
OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TITLES = {
    "m": ("Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "господин", "г-н", "Господин", "Г-н"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "госпожа", "г-жа", "Госпожа", "Г-жа"),
}
GIVEN = {
    "m": (
        "James", "John", "Robert", "Michael", "David", "William", "Richard", "Thomas", "Daniel", "Matthew", "Andrew", "George", "Edward", "Henry", "Paul", "Peter", "Lukas", "Hans", "Jürgen", "Stefan", "Klaus", "Wolfgang", "Dieter",
        "Uwe", "Markus", "Pierre", "Jean", "Louis", "Antoine", "Jacques", "Philippe", "Nicolas", "Julien", "Juan", "Carlos", "José", "Miguel", "Pablo", "Javier", "Fernando", "Diego", "Luis",
    ),
    "f": (
        "Mary", "Patricia", "Linda", "Susan", "Sarah", "Karen", "Nancy", "Emily", "Emma", "Anna", "Laura", "Julia", "Alice", "Helen", "Grace", "Sabine", "Heike", "Ursula", "Petra", "Monika", "Claudia", "Andrea", "Birgit", "Marie",
        "Claire", "Camille", "Sophie", "Isabelle", "Nathalie", "Sylvie", "Catherine", "Juliette", "María", "Carmen", "Lucía", "Elena", "Isabel", "Pilar", "Teresa", "Marta", "Rosa", "Cristina",
    ),
}
GIVEN_CYRILLIC = {
    "m": ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей", "Михаил", "Александр", "Владимир", "Юрий", "Олег", "Игорь", "Павел", "Максим", "Виктор"),
    "f": ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Светлана", "Екатерина", "Людмила", "Галина", "Юлия", "Вера", "Надежда", "Дарья", "Полина"),
}
_TITLE = "(?:" + "|".join(t.replace("-", "\\-") for g in TITLES.values() for t in sorted(g, key=len, reverse=True)) + ")"
_NAME = r"\p{Lu}\p{Ll}{1,30}"
FORMS = {
    "key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|token|secret|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?(?=[A-Za-z_+/.-]*+[0-9])[A-Za-z0-9_+/.-]{8,}+",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,7}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){3,4}|\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}|[0-9]{3}([-.])[0-9]{3}\1[0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![0-9])(?:[2-6][0-9]{12,18}|[2-6][0-9]{3}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{3})?|3[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "name": rf"(?<!\p{{L}}){_TITLE}\.? (?:{_NAME})(?:[ -]{_NAME}){{0,2}}(?!\p{{L}})",
}
TYPES = tuple(FORMS)
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "áéíóúàèìòùâêîôûäöü")
HEX = ("0123456789abcdef",)
#: First octets of public addresses, and of others whose second octet decides in this range (from, to).
SPLIT_OCTETS = {192: (168, 169), 172: (16, 32), 169: (254, 255), 100: (64, 128)}
PUBLIC_OCTETS = tuple(x for x in range(1, 224) if x not in (10, 127, *SPLIT_OCTETS))

#: What an entity may begin with says which forms it may have: letters, or digits and signs (email both).
_BY_LETTER, _BY_SIGN = ("key", "secret", "email", "iban", "name"), ("email", "ip", "phone", "ssn", "card")
ANY = "(?:(?=[A-Za-zгГ])(?:" + "|".join(f"(?:{FORMS[k]})" for k in _BY_LETTER) + ")|(?=[0-9(+._%-])(?:" + "|".join(f"(?:{FORMS[k]})" for k in _BY_SIGN) + "))"
#: Without one of these characters or titles no form matches.
HINT = rf"[0-9@]|A[KS]IA[A-Z]|(?=[MHFSгГ]){_TITLE}\.? \p{{Lu}}"
ROUNDS = 4
#: Marks the borders of entities while a text is cut; a noncharacter, and texts that have it are cut otherwise.
MARK = "\uFDD0"
_ENTITY = "struct<kind:string,original:string,new:string>"


def _message(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256)


def permuted(row: Column, key: str, kind: Column) -> Column:
    """A row of (v, m), v < m, permuted among all rows with the same m: the new v."""

    def added(target: Column, source: Column, number: int) -> Column:
        seed = _message(key, kind, F.lit(number), F.size(target) + F.size(source), F.array_join(F.transform(source, lambda e: e["v"].cast("string")), ","))

        def shifted(blocks: Column) -> Column:
            shift = lambda i: F.conv(F.substring(F.element_at(blocks, F.floor(i / 16).cast("int") + 1), (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
            return F.transform(target, lambda e, i: F.struct(F.pmod(e["v"] + shift(i), e["m"]).alias("v"), e["m"].alias("m")))

        stream = lambda s: F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(target) - 1, F.lit(0)) / 16).cast("int")), lambda b: F.sha2(F.concat(s, b.cast("string")), 256))
        return let(let(seed, stream), shifted)

    def run(halves: Column, number: int) -> Column:
        if number == ROUNDS:
            return F.transform(F.concat(halves["a"], halves["b"]), lambda e: e["v"])
        a, b = halves["a"], halves["b"]
        new = F.struct(added(a, b, number).alias("a"), b.alias("b")) if number % 2 == 0 else F.struct(a.alias("a"), added(b, a, number).alias("b"))
        return let(new, lambda h: run(h, number + 1))

    half = F.ceil(F.size(row) / 2).cast("int")
    return let(F.struct(F.slice(row, F.lit(1), half).alias("a"), F.slice(row, half + 1, F.size(row)).alias("b")), lambda h: run(h, 0))


def _characters(s: Column) -> Column:
    return F.regexp_extract_all(s, F.lit("(?s)."), F.lit(0))


_EVERY = "".join((*CLASSES, *HEX))
_START = [_EVERY.index(x) if x in CLASSES else len(_EVERY) - len(x) for x in (*CLASSES, *HEX)]


def veiled(s: Column, key: str, kind: Column) -> Column:
    """``s`` with its characters permuted within their classes (of the kind ``hex``: among hexadecimal digits), in its own case; characters of no class stay."""
    alphabet = F.array(*(F.lit(c) for c in _EVERY))
    base, many = (F.array(*(F.lit(x) for of, n in zip(values, map(len, (*CLASSES, *HEX)), strict=True) for x in [of] * n)) for values in (_START, [len(x) for x in (*CLASSES, *HEX)]))
    place = lambda c: F.when(kind == "hex", let(F.instr(F.lit(HEX[0]), c), lambda x: F.when(x > 0, x + _START[-1]).otherwise(0))).otherwise(F.instr(F.lit("".join(CLASSES)), F.lower(c)))
    known = lambda at: F.when(at > 0, F.struct((at - 1 - F.element_at(base, at)).alias("v"), F.element_at(many, at).alias("m"), F.element_at(base, at).alias("b"))).otherwise(F.struct(F.lit(0).alias("v"), F.lit(1).alias("m"), F.lit(-1).alias("b")))

    def moved(cs: Column) -> Column:
        def back(rows: Column) -> Column:
            cased = lambda x, c: F.when(c == F.lower(c), x).otherwise(F.upper(x))
            one = lambda j, i: let(F.get(rows, i)["b"], lambda b: F.when(b < 0, F.get(cs, i)).otherwise(cased(F.element_at(alphabet, F.greatest(b + j + 1, F.lit(1))), F.get(cs, i))))
            new = permuted(F.transform(rows, lambda e: F.struct(e["v"].alias("v"), e["m"].alias("m"))), key, kind)
            return F.array_join(F.transform(new, one), "")

        return let(F.transform(cs, lambda c: let(place(c), known)), back)

    return F.when(F.length(s) > 0, let(_characters(s), moved)).otherwise(s)


def _bare(s: Column) -> Column:
    return F.regexp_replace(s, r"[^\p{L}\p{N}]", "")


def _refilled(s: Column, bare: Column) -> Column:
    """``s``, which is short, with its letters and digits exchanged for those of ``bare``."""
    at = lambda i: F.length(_bare(F.substring(s, F.lit(1), i)))
    one = lambda i: let(F.substring(s, i, F.lit(1)), lambda c: F.when(c == "", c).when(_bare(c) == "", c).otherwise(F.substring(bare, at(i), F.lit(1))))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(s)), one), "")


def _ip(s: Column, key: str) -> Column:
    first = F.array(*(F.lit(x) for x in PUBLIC_OCTETS))

    def moved(o: Column) -> Column:
        bounds = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"))
        for x, (a, b) in SPLIT_OCTETS.items():
            bounds = F.when(F.get(o, 0) == x, F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"))).otherwise(bounds)

        def within(r: Column) -> Column:
            wide, second, at = r["b"] - r["a"], F.get(o, 1), F.array_position(first, F.get(o, 0)).cast("int")
            inside = (second >= r["a"]) & (second < r["b"])
            one = lambda v, m: F.struct(v.alias("v"), m.alias("m"))
            row = F.array(
                F.when(at > 0, one(at - 1, F.lit(len(PUBLIC_OCTETS)))).otherwise(one(F.lit(0), F.lit(1))),
                F.when(inside, one(second - r["a"], wide)).otherwise(one(F.when(second < r["a"], second).otherwise(second - wide), 256 - wide)),
                *(one(F.get(o, i), F.lit(256)) for i in (2, 3)),
            )
            other = lambda v: F.when(v < r["a"], v).otherwise(v + wide)
            new = lambda n: F.concat_ws(".", F.when(at > 0, F.get(first, F.get(n, 0))).otherwise(F.get(o, 0)).cast("string"), F.when(inside, F.get(n, 1) + r["a"]).otherwise(other(F.get(n, 1))).cast("string"), F.get(n, 2).cast("string"), F.get(n, 3).cast("string"))
            return let(permuted(row, key, F.lit("ip")), new)

        return let(bounds, within)

    return let(F.transform(F.split(s, r"\."), lambda x: x.cast("int")), moved)


def _luhn(digits: Column) -> Column:
    """The check digit that a string of digits wants."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + let(value(i), lambda v: F.when(v > 9, v - 9).otherwise(v)))
    return F.pmod(10 - total % 10, F.lit(10))


def _mod97(s: Column) -> Column:
    """A string of digits and capital letters (10 to 35) modulo 97."""
    step = lambda a, c: let(F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1, lambda v: F.pmod(a * F.when(v > 9, 100).otherwise(10) + v, F.lit(97)))
    return F.aggregate(_characters(s), F.lit(0), step)


def cycled(names: tuple[str, ...], key: str) -> tuple[str, ...]:
    """Who stands for each of ``names``: the next one in the order of their hashes under the key."""
    order = sorted(names, key=lambda x: hmac.new(key.encode(), x.encode(), hashlib.sha256).digest())
    after = dict(zip(order, [*order[1:], *order[:1]], strict=True))
    return tuple(after[x] for x in names)


_PART = "struct<s:string,kind:string>"


def _parts(*parts: tuple[Column, Column | str | None]) -> Column:
    """Parts of an entity, each with the kind under which it is veiled; those without one stay."""
    return F.array(*(F.struct(s.alias("s"), (k if isinstance(k, Column) else F.lit(k)).cast("string").alias("kind")).cast(_PART) for s, k in parts))


def _front(s: Column, front: str, kind: Column | str, bare: bool = False) -> Column:
    """What the pattern ``front`` matches at the start stays, the rest is veiled; ``bare``: both without separators."""
    plain = _bare if bare else lambda x: x
    return let(F.regexp_extract(s, f"^(?:{front})", 0), lambda f: _parts((plain(f), None), (plain(F.substring(s, F.length(f) + 1, F.length(s))), kind)))


def _name_parts(s: Column, key: str) -> Column:
    def named(t: Column) -> Column:
        parts = F.split(F.substring(s, F.length(t) + 1, F.length(s)), "(?<=[ -])")
        female = F.regexp_extract(t, r"^[^. ]+", 0).isin(*TITLES["f"])

        def part(p: Column, i: Column) -> Column:
            bare, sign = F.regexp_replace(p, "[ -]$", ""), F.regexp_extract(p, "[ -]$", 0)
            other = F.lit(None).cast("string")
            for g, known in (("m", GIVEN["m"]), ("f", GIVEN["f"]), ("m", GIVEN_CYRILLIC["m"]), ("f", GIVEN_CYRILLIC["f"])):
                names, others = (F.array(*map(F.lit, x)) for x in (known, cycled(known, key)))
                new = F.element_at(others, F.greatest(F.array_position(names, bare), F.lit(1)).cast("int"))
                other = F.when((i == 0) & (female if g == "f" else ~female) & F.array_contains(names, bare), F.concat(new, sign)).otherwise(other)
            return let(other, lambda x: F.struct(F.coalesce(x, p).alias("s"), F.when(x.isNull(), "name").alias("kind")).cast(_PART))

        return F.concat(_parts((t, None)), F.transform(parts, part))

    return let(F.regexp_extract(s, rf"^{_TITLE}\.? ", 0), named)


def kind_of(s: Column) -> Column:
    """The first type whose form a detected string has; of the string alone. Null for a card or an IBAN without a valid check: it stays."""
    out = F.lit(TYPES[-1])
    for t in reversed(TYPES[:-1]):
        out = F.when(s.rlike(f"^(?:{FORMS[t]})$"), F.lit(t)).otherwise(out)
    bare = _bare(s)
    luhn = F.right(bare, F.lit(1)).cast("int") == _luhn(F.substring(bare, F.lit(1), F.length(bare) - 1))
    iban = _mod97(F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))) == 1
    return let(out, lambda k: F.when((k != "card") & (k != "iban"), k).when((k == "card") & luhn, k).when((k == "iban") & iban, k))


def surrogate(s: Column, kind: Column, key: str) -> Column:
    """The keyed surrogate of one detected string: its parts veiled, then checks and separators as its type wants them."""
    value = r"[A-Za-z_-]+[ \t]{0,3}[=:][ \t]{0,3}[\"']?"
    is_hex = F.regexp_replace(s, f"^{value}", "").rlike("^[0-9a-f]+$")
    email = F.struct(F.substring_index(s, "@", 1).alias("local"), F.regexp_extract(s, r"@(.*)\.[A-Za-z]+$", 1).alias("domain"), F.regexp_extract(s, r"\.[A-Za-z]+$", 0).alias("top"))
    bare = _bare(s)
    parts = (
        F.when(kind == "key", _front(s, "[A-Z]{4}", "key"))
        .when(kind == "secret", _front(s, value, F.when(is_hex, "hex").otherwise("secret")))
        .when(kind == "email", let(email, lambda e: _parts((e["local"], "email"), (F.lit("@"), None), (e["domain"], "domain"), (e["top"], None))))  # a domain has one surrogate
        .when(kind == "phone", _front(s, r"\+[0-9]{1,3}(?=[ .(-])[ .-]?\(?[0-9]|\+?\(?[0-9]", "phone", bare=True))
        .when(kind == "iban", _parts((F.substring(bare, F.lit(5), F.length(bare)), "iban")))
        .when(kind == "card", _parts((F.substring(bare, 1, 1), None), (F.substring(bare, F.lit(2), F.length(bare) - 2), "card")))
        .when(kind == "ssn", _parts((s, "ssn")))
        .otherwise(_name_parts(s, key))
    )

    def whole(new: Column) -> Column:
        country = F.substring(bare, 1, 2)
        checked = F.when(kind == "card", F.concat(new, _luhn(new).cast("string"))).when(kind == "iban", F.concat(country, F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0"), new)).otherwise(new)
        return F.when(kind.isin("phone", "card", "iban"), let(checked, lambda x: _refilled(s, x))).otherwise(new)

    joined = let(parts, lambda ps: F.array_join(F.transform(ps, lambda p: F.when(p["kind"].isNull(), p["s"]).otherwise(veiled(p["s"], key, p["kind"]))), ""))
    return F.when(kind.isNull(), s).when(kind == "ip", _ip(s, key)).otherwise(let(joined, whole))


def canonical(s: Column, kind: Column) -> Column:
    """What two spellings of an entity share: of numbers their digits and letters, of an address what isn't case."""
    return F.when(kind.isin("email", "ip"), F.lower(s)).when(kind.isin("secret", "key"), s).otherwise(_bare(F.lower(s)))


def pieces(text: Column) -> Column:
    """A text cut at the borders of its entities: those are the pieces at odd places, from 0. Null where nothing is hinted at."""
    marked = F.split(F.regexp_replace(text, ANY, f"{MARK}$0{MARK}"), MARK, -1)
    gaps, found = F.split(text, ANY, -1), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    both = F.slice(F.flatten(F.zip_with(gaps, found, lambda g, e: F.array(g, e))), F.lit(1), 2 * F.size(gaps) - 1)
    return F.when(text.rlike(HINT), F.when(F.contains(text, F.lit(MARK)), both).otherwise(marked))


def with_entities(docs: DataFrame, key: str, text: str = "text", entities: str = "_pii") -> DataFrame:
    """``docs`` with surrogates in the text, and the entities: array of (kind, original, new); null where nothing is hinted at."""
    if not key:
        raise ValueError("surrogates need a key")
    each = lambda s: let(kind_of(s), lambda k: F.struct(k.alias("kind"), s.alias("original"), surrogate(s, k, key).alias("new")))

    def rebuilt(p: Column) -> Column:
        def done(e: Column) -> Column:
            gaps = F.filter(p, lambda _, i: i % 2 == 0)
            new = F.array_join(F.zip_with(gaps, F.concat(F.transform(e, lambda x: x["new"]), F.array(F.lit(""))), lambda gap, x: F.concat(gap, x)), "")
            return F.struct(F.when(F.size(e) > 0, new).alias("text"), e.alias("entities"))

        return let(F.transform(F.filter(p, lambda _, i: i % 2 == 1), each), done)

    body = F.col(text).cast("string")
    found = docs.withColumn("_found", let(pieces(body), lambda p: F.when(p.isNotNull(), rebuilt(p))))
    return found.withColumns({text: F.coalesce("_found.text", body), entities: F.col("_found.entities")}).drop("_found")


def entities(column: str = "_pii") -> Column:
    """The typed entities of ``with_entities``; empty where there is nothing."""
    none = F.array().cast(f"array<{_ENTITY}>")
    return F.filter(F.coalesce(column, none), lambda e: e["kind"].isNotNull())


def collisions(rows: DataFrame, column: str = "_pii") -> int:
    """Number of surrogates in a table of ``with_entities`` that stand for two entities."""
    one = rows.select(F.explode(entities(column)).alias("e"))
    one = one.select("e.kind", canonical(F.col("e.original"), F.col("e.kind")).alias("was"), canonical(F.col("e.new"), F.col("e.kind")).alias("is"))
    return one.groupBy("kind", "is").agg(F.min("was").alias("a"), F.max("was").alias("b")).where("a <> b").count()


def replace(docs: DataFrame, key: str, text: str = "text", entities: str = "_pii", tries: int = 8) -> DataFrame:
    """``docs`` with surrogates in the text, and the entities as ``with_entities`` has them; read from the table that the check read."""
    docs = docs.drop(entities)
    inner, names, _ = aside(docs)
    for k in range(tries):
        path = f"{shared_dir(docs.sparkSession).rstrip('/')}/pii-{uuid.uuid4().hex}"
        with_entities(inner, key if not k else f"{key}#{k}", names[docs.columns.index(text)], "_entities").write.parquet(path)
        rows = docs.sparkSession.read.parquet(path)
        if not collisions(rows, "_entities"):
            return rows.toDF(*docs.columns, entities)
    raise RuntimeError(f"surrogates collide under each of {tries} keys")
