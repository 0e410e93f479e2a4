"""Personal data and secrets replaced by keyed, type-consistent surrogates.

Entities are found by one pattern; full names that stand behind a title
anywhere in the corpus are then found without one, too. What identifies an
entity, its atom (letters and digits without case and punctuation; an address
as a whole; the national part of a phone number; each name of a person; a
secret without its label), maps to a surrogate atom through a keyed hash, so an
entity has one surrogate wherever and however it is written. Over the distinct
atoms of the whole corpus, surrogates that meet each other or an atom that is
really there are drawn again, alone, from a space that widens with every few
draws, until none do: different entities stay different. The surrogate takes
the entity's format: digit for digit, letter for letter, case and punctuation
as they were, issuer digits, country codes and check digits of cards and IBANs
in order, names of the same gender and script. Signs are drawn only for secrets
that have next to nothing else; masks (`******`) pass unchanged.

An IPv6 address written short and in full has two surrogates.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed

#: Titles by gender, then names that stand in for others.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Господин", "Κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Signora", "Госпожа", "Κυρία"),
    "n": ("Dr", "Prof", "Mx", "Доктор", "Δρ"),
}
GIVEN = {
    ("m", "Latin"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Louis", "Martin", "Nico", "Oscar", "Paul"),
    ("f", "Latin"): ("Anna", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helen", "Irene", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"),
    ("n", "Latin"): ("Alex", "Andrea", "Charlie", "Dominique", "Jamie", "Kim", "Luca", "Maxime", "Nikita", "Robin", "Sam", "Taylor"),
    ("m", "Cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Максим", "Олег", "Павел"),
    ("f", "Cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Лариса", "Мария", "Ольга", "Софья"),
    ("n", "Cyrillic"): ("Саша", "Женя", "Валя", "Слава", "Шура"),
    ("m", "Greek"): ("Αλέξανδρος", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"),
    ("f", "Greek"): ("Άννα", "Δήμητρα", "Ελένη", "Κατερίνα", "Μαρία", "Σοφία"),
    ("n", "Greek"): ("Άγγελος", "Φώτης", "Χάρης"),
}
SURNAMES = {
    "Latin": ("Abel", "Brandt", "Carver", "Dorn", "Ellis", "Fischer", "Garnier", "Holm", "Ibarra", "Jansen", "Keller", "Lambert", "Moreno", "Novak", "Olsen", "Pereira", "Quinn", "Romero", "Sander", "Tanner", "Ulrich", "Vidal", "Weber", "Young", "Zeller"),
    "Cyrillic": ("Белов", "Волков", "Громов", "Зайцев", "Козлов", "Лебедев", "Морозов", "Новиков", "Орлов", "Соколов"),
    "CyrillicF": ("Белова", "Волкова", "Громова", "Зайцева", "Козлова", "Лебедева", "Морозова", "Новикова", "Орлова", "Соколова"),
    "Greek": ("Αγγελίδης", "Βασιλείου", "Γεωργίου", "Δημητρίου", "Ιωάννου", "Νικολάου", "Παππάς", "Σταύρου"),
}
_NAME = r"\p{Lu}[\p{L}'’-]+"
_TITLE = r"(?:" + "|".join(sorted((t for g in TITLES.values() for t in g), key=lambda t: (-len(t), t))) + r")\.?"
_ASSIGN = r"(?i:password|passwd|pwd|secret|api[_-]?key|access[_-]?key|token)\s{0,3}[=:]\s{0,3}[\"']?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Type and pattern of each kind of entity; where two fit at one place, the earlier counts. A group that repeats without
#: bound is possessive: any other recurses once a repetition, and a long text overflows the stack.
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,255}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "AWS_KEY": r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])",
    "SECRET": _ASSIGN + r"[^\s\"']{6,}+",
    "IPV4": rf"(?<!\d\.)(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "IPV6": r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])|(?=[0-9A-Fa-f:]{0,39}\d)(?:[0-9A-Fa-f]{1,4}:){1,6}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?(?![0-9A-Za-z:])",
    "IBAN": r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "SSN": r"\d{3}-\d{2}-\d{4}(?![0-9-])",
    "PHONE": r"(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?![0-9])|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![0-9])|\d{3}[.-]\d{3}[.-]\d{4}(?![0-9])",
    "CARD": r"\d(?:[ -]?\d){12,18}(?![0-9])",
    "HEX_KEY": r"[0-9a-f]{32,128}(?![0-9A-Za-z])",
    "PERSON": rf"{_TITLE} {_NAME}(?: {_NAME})?",
}
#: Of a secret of signs alone, or nearly so, the signs are drawn too; one sign over and over, with what ends a sentence, is a mask and hides nothing.
SIGNS = "!#$%&*+-/:;=?@^_|~"
FEW_SIGNED = 4
MASK = r"^([^\p{L}\p{N}])\1{3,}[.,;:!?)]*$"
ANY = r"(?<![\p{L}\p{N}])(?:" + "|".join(PATTERNS.values()) + ")"
#: Two or more names in a row, none of them the start of something else, looked at where the corpus has full names behind titles.
NAMES = rf"{_NAME}(?: (?!{'|'.join(PATTERNS.values())}){_NAME})++"
#: A word's edges.
WORD = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: Those of one that isn't part of an address.
APART = r"(?<![\p{L}\p{N}@._%+/-])", r"(?![\p{L}\p{N}@_/]|[.-][\p{L}\p{N}])"
#: Fixed value: country calling codes; what isn't listed has three digits.
CALLING = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
#: Country code and trunk zeros stay as they are; so does what ends a sentence behind a secret.
PHONE_HEAD = rf"^(?:\+(?:{CALLING})[ .-]?)?\(?(?:0{{1,2}}(?=.*[1-9]))?"
ENDING = r"[.,;:!?)\]]*$"
RUNS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"
#: Draws after which a surrogate has one character, one name or one octet more.
WIDER, MORE_NAMES, MORE_OCTETS = 8, 4, 64


def _type(entity: Column) -> Column:
    out = F
    for name, pattern in PATTERNS.items():
        out = out.when(entity.rlike(rf"^(?:{pattern})$"), F.lit(name))
    return out


def _masked() -> Column:
    return (F.col("kind") == "SECRET") & F.col("atom").rlike(MASK)


def _secret(entity: Column) -> tuple[Column, Column, Column, Column]:
    """Label, value and ending of a secret, and whether the value has so few letters and digits that its signs count."""
    label = F.regexp_extract(entity, f"^({_ASSIGN})", 1)
    whole = F.substring(entity, F.length(label) + 1, F.length(entity))
    bare = F.regexp_replace(whole, ENDING, "")
    value = F.when(F.length(bare) > 0, bare).otherwise(whole)
    return label, value, F.substring(whole, F.length(value) + 1, F.length(whole)), F.length(_bare(value)) < FEW_SIGNED


def _pick(options: dict, at: Column) -> Column:
    out = F
    for key, names in options.items():
        out = out.when(at == F.lit("/".join(key) if isinstance(key, tuple) else key), F.array(*map(F.lit, names)))
    return out


def _digit(hexes: Column, i: Column) -> Column:
    """The i-th pseudo-random byte of a chain of hashes."""
    return F.conv(F.substring(F.element_at(hexes, (F.floor(i / 32) + 1).cast("int")), (2 * F.pmod(i, F.lit(32)) + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _with_hexes(atoms: DataFrame, key: str) -> DataFrame:
    """A column `hexes`: as many hashes as the atom needs, two at least, from one keyed digest of (kind, atom, draw)."""
    word = F.concat_ws("\x01", F.lit(key), "kind", "atom", F.col("draw").cast("string"))
    digested = atoms.withColumn("digest", F.sha2(F.concat(F.lit(key), F.sha2(word, 256)), 256))
    further = F.transform(F.sequence(F.lit(1), F.floor(F.length("atom") / 32).cast("int") + 1), lambda b: F.sha2(F.concat(F.lit(key), F.col("digest"), b.cast("string")), 256))
    return digested.withColumn("hexes", F.concat(F.array("digest"), further)).drop("digest")


def _luhn(digits: Column, ending: bool) -> Column:
    """Luhn sum of a string of digits; ending: the last digit is the check digit."""
    each = F.split(F.reverse(digits), "")
    weighed = F.transform(each, lambda c, i: F.when(F.pmod(i, F.lit(2)) == (1 if ending else 0), F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b)


def _rest_97(digits: Column) -> Column:
    """The remainder by 97 of a number in digits and letters, which count from a = 10 on."""
    return F.aggregate(F.split(digits, ""), F.lit(0), lambda s, c: F.when(c.rlike("^[a-z]$"), F.pmod(s * 100 + F.ascii(c) - 87, F.lit(97))).when(c.rlike("^[0-9]$"), F.pmod(s * 10 + c.cast("int"), F.lit(97))).otherwise(s))


def _iban(atom: Column, drawn: Column) -> Column:
    """The drawn account with check digits of its own, if those of the atom are right."""
    turned = lambda x, check: F.concat(F.substring(x, F.lit(5), F.length(x)), F.substring(x, F.lit(1), F.lit(2)), check)
    right = _rest_97(turned(atom, F.substring(atom, 3, 2))) == 1
    check = F.lpad((98 - _rest_97(turned(drawn, F.lit("00")))).cast("string"), 2, "0")
    return F.when(right, F.concat(F.substring(drawn, F.lit(1), F.lit(2)), check, F.substring(drawn, F.lit(5), F.length(drawn)))).otherwise(drawn)


def _drawn() -> Column:
    """The surrogate of an atom at its draw: the `keep` first characters stay, those from `last` on, and all of a mask."""
    kind, atom, h, hexadecimal = F.col("kind"), F.col("atom"), F.col("hexes"), F.col("hexadecimal")
    two = lambda i: _digit(h, F.pmod(2 * i, F.lit(64))) * 256 + _digit(h, F.pmod(2 * i + 1, F.lit(64)))
    swapped = F.transform(
        F.split(atom, ""),
        lambda c, i: F.when((i < F.col("keep")) | (i >= F.col("last")) | F.col("masked"), c)
        .when(c.rlike(r"^\d$"), F.when((i == F.col("keep")) & kind.isin("PHONE", "CARD"), F.pmod(_digit(h, i), F.lit(8)) + 2).otherwise(F.pmod(_digit(h, i), F.lit(10))).cast("string"))
        .when(c.rlike("^[a-z]$"), F.char(F.lit(97) + F.pmod(_digit(h, i), F.when(hexadecimal, 6).otherwise(26))))
        .when(c.rlike(r"^\p{IsCyrillic}$"), F.substring(F.lit("абвгдежзиклмнопрстуфхцчшэюя"), F.pmod(_digit(h, i), F.lit(27)) + 1, F.lit(1)))
        .when(c.rlike(r"^\p{IsGreek}$"), F.substring(F.lit("αβγδεζηθικλμνξοπρστυφχψω"), F.pmod(_digit(h, i), F.lit(24)) + 1, F.lit(1)))
        .when(c.rlike(r"^\p{L}$"), F.char(F.lit(97) + F.pmod(_digit(h, i), F.lit(26))))
        .when(c.rlike(r"^\p{N}$"), F.pmod(_digit(h, i), F.lit(10)).cast("string"))
        .when(F.col("signed"), F.substring(F.lit(SIGNS), F.pmod(_digit(h, i), F.lit(len(SIGNS))) + 1, F.lit(1)))
        .otherwise(c),
    )
    same = F.array_join(swapped, "")
    more = F.transform(F.sequence(F.lit(0), F.floor(F.col("draw") / WIDER).cast("int")), lambda i: F.when(i > 0, F.pmod(_digit(h, F.pmod(i, F.lit(32))), F.lit(9)) + 1).cast("string"))
    more = F.array_join(more, "")
    more = F.when(F.col("masked"), "").when(kind == "EMAIL", F.translate(more, "123456789", "abcdefghi")).otherwise(more)
    plain = F.concat(F.substring(same, F.lit(1), F.col("keep")), more, F.substring(same, F.col("keep") + 1, F.length(same)))
    head = F.substring(plain, F.lit(1), F.length(plain) - 1)
    card = F.when(_luhn(atom, True) % 10 == 0, F.concat(head, F.pmod(10 - F.pmod(_luhn(head, False), F.lit(10)), F.lit(10)).cast("string"))).otherwise(plain)
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3) + F.floor(F.col("draw") / MORE_OCTETS).cast("int")), lambda i: (F.pmod(two(i), F.lit(254)) + 1).cast("string")), ".")
    names = F.coalesce(_pick({f"GIVEN/{g}/{s}": n for (g, s), n in GIVEN.items()} | {f"SURNAME/{s}": n for s, n in SURNAMES.items()}, kind), F.array(F.lit("")))
    named = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.col("draw") / MORE_NAMES).cast("int")), lambda i: F.element_at(names, F.pmod(two(i), F.size(names)) + 1)), "-")
    return F.when(kind == "IPV4", octets).when(kind == "CARD", card).when(kind == "IBAN", _iban(atom, plain)).when(kind.startswith("GIVEN") | kind.startswith("SURNAME"), named).otherwise(plain)


def _bare(entity: Column) -> Column:
    return F.regexp_replace(F.lower(entity), r"[^\p{L}\p{N}]", "")


def _atoms(entity: Column, kind: Column) -> Column:
    """What identifies an entity: an array of (kind, atom, keep, tail)."""
    atom = lambda k, a, keep=F.lit(0), tail=F.lit(0): F.struct(k.alias("kind"), a.alias("atom"), keep.cast("int").alias("keep"), tail.cast("int").alias("tail"))
    title, names = F.regexp_extract(entity, rf"^({_TITLE}) ", 1), F.split(F.regexp_replace(entity, rf"^{_TITLE} ", ""), " ")
    gender = F
    for g, titles in TITLES.items():
        gender = gender.when(F.rtrim(title, F.lit(".")).isin(*titles), F.lit(g))
    gender = F.when((gender == "n") & names[0].isin(*(n for (g, _), ns in GIVEN.items() if g == "f" for n in ns)), F.lit("f")).when((gender == "n") & names[0].isin(*(n for (g, _), ns in GIVEN.items() if g == "m" for n in ns)), F.lit("m")).otherwise(gender)
    script = lambda n: F.when(n.rlike(r"\p{IsCyrillic}"), "Cyrillic").when(n.rlike(r"\p{IsGreek}"), "Greek").otherwise("Latin")
    surname = F.element_at(names, -1)
    family = F.when(surname.rlike("[ая]$"), "CyrillicF").otherwise(script(surname))
    person = F.when(F.size(names) > 1, F.array(atom(F.concat_ws("/", F.lit("GIVEN"), gender, script(names[0])), F.lower(names[0])), atom(F.concat_ws("/", F.lit("SURNAME"), family), F.lower(surname)))).otherwise(F.array(atom(F.concat_ws("/", F.lit("SURNAME"), family), F.lower(surname))))
    kept = F.when(kind == "CARD", 1).when(kind == "AWS_KEY", 4).when(kind == "IBAN", 2).otherwise(0)
    tail = F.when(kind == "EMAIL", F.length(_bare(F.regexp_extract(entity, r"\.([A-Za-z0-9-]+)$", 1)))).otherwise(0)
    secret = F.array(atom(kind, F.lower(F.translate(_secret(entity)[1], "İ", "i"))))
    national = F.array(atom(kind, _bare(F.regexp_replace(entity, PHONE_HEAD, ""))))
    return F.when(kind == "PERSON", person).when(kind == "IPV4", F.array(atom(kind, entity))).when(kind == "SECRET", secret).when(kind == "PHONE", national).otherwise(F.array(atom(kind, _bare(entity), kept, tail)))


def _cased(like: Column, text: Column, further: Column | int = 0) -> Column:
    """Text with capitals where `like`, from `further` characters on, has them."""
    shown = F.concat(F.array_repeat(F.lit(""), further) if not isinstance(further, int) else F.array().cast("array<string>"), F.split(like, ""))
    return F.array_join(F.zip_with(shown, F.split(text, ""), lambda c, y: F.when(c.rlike(r"^\p{Lu}$"), F.upper(y)).otherwise(y)), "")


def _written(entity: Column, kind: Column, atoms: Column) -> Column:
    """The surrogate atoms in the entity's format; characters that a wider surrogate has more stand in its first run."""
    label, value, ending, _ = _secret(entity)
    head = F.when(kind == "PHONE", F.regexp_extract(entity, PHONE_HEAD, 0)).otherwise("")
    body, new = F.substring(entity, F.length(head) + 1, F.length(entity)), atoms[0]
    more = F.length(new) - F.length(_bare(body))
    laid = F.aggregate(
        F.regexp_extract_all(body, F.lit(RUNS), F.lit(0)),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("n"), more.alias("more")),
        lambda s, t: F.when(
            t.rlike(r"^[\p{L}\p{N}]"),
            F.struct(F.concat(s["out"], _cased(t, F.substring(new, s["n"] + 1, F.length(t) + s["more"]))).alias("out"), (s["n"] + F.length(t) + s["more"]).alias("n"), F.lit(0).alias("more")),
        ).otherwise(F.struct(F.concat(s["out"], t).alias("out"), s["n"].alias("n"), s["more"].alias("more"))),
        lambda s: s["out"],
    )
    names = F.split(F.regexp_replace(entity, rf"^{_TITLE} ", ""), " ")
    loud = lambda old, name: F.when((F.length(old) > 1) & (F.upper(old) == old), F.upper(name)).otherwise(name)
    person = F.concat(F.regexp_extract(entity, rf"^({_TITLE} )", 1), F.array_join(F.zip_with(names, atoms, lambda old, name: loud(old, F.coalesce(name, old))), " "))
    secret = F.concat(label, _cased(value, new, F.length(new) - F.length(value)), ending)
    return F.when(kind.isin("PERSON", "NAMES"), person).when(kind == "IPV4", new).when(kind == "SECRET", secret).otherwise(F.concat(head, laid))


def _without_family(text: Column, before: Column, family: Column) -> Column:
    """The text with a family's (atom, surrogate) name replaced where it stands alone with a capital; one that the text before also has in small letters is a word there, and stays."""
    name, other = family["atom"], family["surrogate"]
    plain = F.regexp_replace(text, F.concat(F.lit(WORD[0]), F.upper(name), F.lit(WORD[1])), F.upper(other))
    return F.when(F.rlike(before, F.concat(F.lit(APART[0]), name, F.lit(APART[1]))), text).otherwise(F.regexp_replace(plain, F.concat(F.lit(WORD[0] + r"(?=\p{Lu})(?iu:"), name, F.lit(")" + WORD[1])), other))


class Surrogates:
    """Documents (doc_id, text) with surrogates for what PATTERNS find, under a secret key.

    In a document with a person, the surname is replaced wherever it stands
    with a capital, unless the document has the same word in small letters;
    n_entities doesn't count these. An address whose first part has more than
    256 characters is replaced from its last 256 on, from the start of a word.

    Null text counts as empty and stays empty text. Rows of one doc_id and
    text get the same surrogates; a null doc_id is an id like any other. Only
    doc_id and text are read.
    """

    def __init__(self, docs: DataFrame, key: str):
        self.key, self.pattern = key, ANY
        text = F.coalesce(F.col("text"), F.lit(""))
        self.docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
        self.found = checkpointed(self._entities(ANY))
        pair = F.max(F.when(F.col("part") == 0, F.struct("atom", "kind"))).alias("given"), F.max(F.when(F.col("part") == 1, F.struct("atom", "kind"))).alias("family")
        people = self.found.filter("type = 'PERSON'").groupBy("doc_id", "tie", "at").agg(*pair).filter("family is not null")
        people = checkpointed(people.groupBy("given.atom", "family.atom").agg(F.min("given.kind").alias("given_kind"), F.min("family.kind").alias("family_kind")).toDF("given", "family", "given_kind", "family_kind"))
        if people.limit(1).count():
            self.pattern = rf"(?:{ANY})|(?<![\p{{L}}\p{{N}}]){NAMES}"
            self.found = checkpointed(self._with_people(self._entities(self.pattern), people))

    def _entities(self, pattern: str) -> DataFrame:
        """(doc_id, tie, at, entity, type, part, kind, atom, keep, tail): the atoms of what the pattern finds, the entity with the first of them; names without a title have one for each name."""
        found = self.docs.select("doc_id", "tie", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found")).filter(F.size("found") > 0).dropDuplicates(["doc_id", "tie"])
        each = found.select("doc_id", "tie", F.posexplode("found").alias("at", "entity")).withColumn("type", F.coalesce(_type(F.col("entity")), F.lit("NAMES")))
        name = F.transform(F.split("entity", " "), lambda n: F.struct(F.lit("NAME").alias("kind"), F.lower(n).alias("atom"), F.lit(0).alias("keep"), F.lit(0).alias("tail")))
        atoms = F.when(F.col("type") == "NAMES", name).otherwise(_atoms(F.col("entity"), F.col("type")))
        # a row of a hundred thousand names is written once, not with each of them
        parts = F.transform(atoms, lambda x, i: F.struct(*(x[c].alias(c) for c in ("kind", "atom", "keep", "tail")), F.when(i == 0, F.col("entity")).alias("entity")))
        return each.select("doc_id", "tie", "at", "type", F.posexplode(parts).alias("part", "of")).select("doc_id", "tie", "at", "of.entity", "type", "part", "of.kind", "of.atom", "of.keep", "of.tail")

    def _with_people(self, found: DataFrame, people: DataFrame) -> DataFrame:
        """Names without a title stay where two in a row are a known full name, with a null kind for those of them that belong to none."""
        w = Window.partitionBy("doc_id", "tie", "at").orderBy("part")
        keep = ["doc_id", "tie", "at", "entity", "type", "part", "kind", "atom", "keep", "tail"]
        names = found.filter("type = 'NAMES'").withColumn("next", F.lead("atom").over(w)).drop("kind")
        met = names.join(people, (names["atom"] == people["given"]) & (names["next"] == people["family"]), "left")
        # a name that is one person's last and the next one's first is taken once
        met = met.withColumn("kind", F.least("given_kind", F.lag("family_kind").over(w)))
        known = met.withColumn("any", F.max("kind").over(Window.partitionBy("doc_id", "tie", "at"))).filter("any is not null")
        return found.filter("type != 'NAMES'").select(keep).unionByName(known.select(keep))

    def table(self) -> DataFrame:
        """(kind, atom, surrogate) of every distinct atom."""
        kind, atom = F.col("kind"), F.col("atom")
        atoms = self.found.filter("kind is not null").groupBy("kind", "atom").agg(F.min("keep").alias("keep"), F.min("tail").alias("tail"))
        # names start with as many parts as their number asks for
        sizes = {r.kind: r.n for r in atoms.filter("kind rlike '^(GIVEN|SURNAME)'").groupBy("kind").agg(F.count("*").alias("n")).collect()}  # a row for each list of names
        lists = {f"GIVEN/{g}/{s}": len(n) for (g, s), n in GIVEN.items()} | {f"SURNAME/{s}": len(n) for s, n in SURNAMES.items()}
        start = F
        for k, n in sorted(sizes.items()):
            start = start.when(kind == k, MORE_NAMES * max(0, math.ceil(math.log(n, lists[k]) - 1e-9) - 1))
        start = start.otherwise(0) if sizes else F.lit(0)
        hexadecimal = kind.isin("SECRET", "HEX_KEY") & F.substring(atom, F.col("keep") + 1, F.length(atom)).rlike("^[0-9a-f]+$") | (kind == "IPV6")
        waiting = checkpointed(atoms.select(
            "kind", "atom", "keep", F.regexp_replace(kind, "^(GIVEN|SURNAME).*", "NAME").alias("space"), (F.length(atom) - F.col("tail")).alias("last"),
            hexadecimal.alias("hexadecimal"), _masked().alias("masked"), ((kind == "SECRET") & (F.length(_bare(atom)) < FEW_SIGNED)).alias("signed"), start.alias("draw"),
        ))
        claimed = waiting.select("space", F.col("atom").alias("x")).distinct()
        settled = None
        while True:
            # written out first: the filters that joins bring with them would compute all this again, within each lambda
            drawn = checkpointed(_with_hexes(waiting, self.key).withColumn("surrogate", _drawn()).drop("hexes").withColumn("x", F.lower("surrogate")))
            # what is really there or given already is nobody's; of all that want a value, the least atom has it
            owner = drawn.join(claimed, ["space", "x"], "left_anti").groupBy("space", "x").agg(F.min(F.struct("kind", "atom")).alias("owner"))
            good = F.coalesce(F.col("owner") == F.struct("kind", "atom"), F.lit(False)) | F.col("masked")
            judged = checkpointed(drawn.join(owner, ["space", "x"], "left").withColumn("good", good).drop("owner"))
            now = judged.filter("good")
            settled = now if settled is None else settled.unionByName(now)
            waiting = judged.filter("not good").drop("x", "surrogate", "good").withColumn("draw", F.col("draw") + 1)
            if not waiting.limit(1).count():
                return settled.select("kind", "atom", "surrogate")
            claimed = claimed.unionByName(now.select("space", "x"))

    def texts(self) -> DataFrame:
        """doc_id, text with surrogates, n_entities, types: a row for each document."""
        named = self.found.join(self.table(), ["kind", "atom"], "left")
        parts = F.array_sort(F.collect_list(F.struct("part", "surrogate")))
        family = F.when(F.col("kind").startswith("SURNAME"), F.struct("atom", "surrogate"))
        entities = named.groupBy("doc_id", "tie", "at").agg(F.max("entity").alias("entity"), F.first("type").alias("type"), parts.alias("of"), F.collect_set(family).alias("families"))
        # a surrogate for each name, null for those that stay
        entities = entities.withColumn("atoms", F.transform("of", lambda x: x["surrogate"]))
        entities = entities.withColumn("written", _written(F.col("entity"), F.col("type"), F.col("atoms"))).withColumn("type", F.when(F.col("type") == "NAMES", "PERSON").otherwise(F.col("type")))
        by_doc = entities.groupBy(F.col("doc_id").alias("found_id"), F.col("tie").alias("found_tie")).agg(F.array_sort(F.collect_list(F.struct("at", "written", "type"))).alias("new"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("families")))).alias("families"))
        joined = self.docs.join(by_doc, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("tie") == F.col("found_tie")), "left")
        there = F.col("new").isNotNull()
        # between texts and what was found behind each; a column each, since a lambda would compute them for every element
        cut = joined.withColumn("between", F.when(there, F.split("text", self.pattern, -1))).withColumn("said", F.when(there, F.regexp_extract_all("text", F.lit(self.pattern), F.lit(0))))
        cut = cut.withColumn("whole", F.zip_with("between", "said", lambda p, e: F.concat(p, F.coalesce(e, F.lit("")))))
        before = lambda i: F.when(i > 0, F.col("new")[F.greatest(i - 1, F.lit(0))]["at"] + 1).otherwise(0)
        pieces = F.transform("new", lambda x, i: F.concat(F.array_join(F.slice("whole", before(i) + 1, x["at"] - before(i)), ""), F.col("between")[x["at"]], x["written"]))
        after = F.element_at("new", -1)["at"] + 1
        text = F.concat(F.array_join(pieces, ""), F.array_join(F.slice("whole", after + 1, F.greatest(F.size("whole") - after, F.lit(0))), ""))
        done = cut.withColumn("new_text", text).withColumn("new_text", F.aggregate("families", F.col("new_text"), lambda t, x: _without_family(t, F.col("text"), x)))
        return done.select("doc_id", F.when(there, F.col("new_text")).otherwise(F.col("text")).alias("text"), F.when(there, F.size("new")).otherwise(0).cast("long").alias("n_entities"), F.coalesce(F.array_sort(F.array_distinct(F.transform("new", lambda x: x["type"]))), F.array().cast("array<string>")).alias("types"))
