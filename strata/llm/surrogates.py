"""Surrogates for personal data, in DataFrame and SQL functions only.

Found entities are replaced by made-up ones of the same type and format: digits stay
digits in the same layout, cards keep their first digit and whether their check digit is
right, telephone numbers their country code, mail addresses the classes of their
characters and their top-level domain, private network addresses their range, names their
script, their case and the gender of the title before them. A replacement depends on a
key, the type and the entity's canonical value, so every mention of it, whatever its
layout, gets the same one; given and family names are entities of their own, so "Mr Ole
Berg" and "Mr Berg" still agree, and so does a later "Berg" in the same text.

Distinctness is checked over the whole corpus. Distinct entities form a table; where two of
a type would get the same surrogate, or a surrogate is itself an entity that occurs, all but
the first draw again until none is left. This ends however many entities there are. Names and
mail addresses get longer with every third draw. Numbers and network addresses come from a
small space and are moved by a keyed permutation of it that leaves nothing in its place: two
halves are shifted in turn by digests of each other, one is added, and the shifts are undone.
Where a type is not settled after ``ROUNDS`` draws, because so much of its space occurs, all its
entities keep the first permutation: distinct still, though some become others that occur.
Nearly all entities keep their first draw, which is computed in place; only redrawn ones are
joined to the documents that mention them.

Found are: mail addresses; IPv4 addresses; numbers like 123-45-6789; North American telephone
numbers and any with a plus sign and 8 to 15 digits in groups; card numbers of 13 to 19 digits;
names after a title of five languages, with initials, particles and any number of capital
words, and the bare family name elsewhere in that text. Not found are names without a title
that no titled mention in the text shares, national numbers of other countries without a plus
sign, postal addresses, dates of birth, and IPv6 addresses.

Defined cases: a NULL text stays NULL, an empty one empty; repeated rows give equal results;
NULL ids are ids like any other; an empty table gives an empty result; all other columns
pass through ``with_surrogates``, and ``n_entities`` replaces a column of that name; an empty
key is refused.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_LATIN_TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mlle"),
    "m": ("Mr", "Herr", "Señor", "Monsieur"),
    "u": ("Dr", "Prof"),
}
_CYRILLIC_TITLES = {"f": ("госпожа", "г-жа"), "m": ("господин", "г-н")}
TITLES = {g: (*_LATIN_TITLES[g], *_CYRILLIC_TITLES.get(g, ())) for g in _LATIN_TITLES}
_TITLE = "(?:" + "|".join(t for group in TITLES.values() for t in group) + ")"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_INITIAL = r"\p{Lu}\."
_PARTICLE = "(?:van|von|der|den|de|la|del|di|da|dos)"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
             r"|(?<![\w+])\+\d(?:[ .()-]{0,2}\d){7,14}(?!\d)",
    "card": r"(?<![\d-])(?:\d[ -]?){12,18}\d(?![\d-])",
    "name": rf"(?<!\p{{L}}){_TITLE}\.? (?:{_INITIAL} ?)*(?:{_PARTICLE} )*{_NAME}(?:(?: {_INITIAL})* (?:{_PARTICLE} )*{_NAME})*",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
GIVEN = {
    "latin": {"f": ("Anna", "Clara", "Elena", "Ines", "Julia", "Lena", "Maria", "Nora", "Paula", "Rosa", "Sara", "Vera"),
              "m": ("Adam", "Bruno", "David", "Emil", "Felix", "Hugo", "Jonas", "Leo", "Marco", "Oscar", "Peter", "Victor"),
              "u": ("Alex", "Chris", "Kim", "Robin", "Sam", "Noel", "Toni", "Luca", "Sasha", "Jules", "Andrea", "Dominique")},
    "cyrillic": {"f": ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"),
                 "m": ("Антон", "Борис", "Виктор", "Иван", "Лев", "Олег", "Павел", "Юрий")},
}
SYLLABLES = {
    "latin": ("ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ha", "jo", "ka", "ke", "la", "le",
              "lo", "ma", "me", "mo", "na", "ne", "no", "pa", "ra", "re", "ro", "sa", "ta", "te", "va", "ve"),
    "cyrillic": ("ба", "бе", "бо", "ва", "ве", "га", "го", "да", "до", "за", "ка", "ко", "ла", "ле", "ма", "мо"),
}
ENDINGS = {"latin": ("rn", "ll", "nd", "sk", "n", "r", "s", "t"), "cyrillic": ("рн", "лк", "нд", "ск", "н", "р", "с", "т")}


def let(value: Column, body) -> Column:
    """``body`` of a value computed once: a lambda's argument is not expanded where it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _type(m: Column) -> Column:
    """Which pattern found a match; they are tried in order, as in ``ANY``."""
    kind = F.lit("name")
    for name in reversed([k for k in PATTERNS if k != "name"]):
        kind = F.when(m.rlike(rf"\A(?:{PATTERNS[name]})\z"), F.lit(name)).otherwise(kind)
    return kind


def _number(stream: Column, i, below: int) -> Column:
    """The ``i``-th number (from 0) of a stream of hexadecimal digits, four to a number."""
    at = F.lit(i) if isinstance(i, int) else i
    return F.conv(F.substr(stream, F.pmod(at, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int") % below


def _stream(key: str, kind: str, value: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(kind), value, attempt.cast("string")), 512)


def _pick(options: tuple, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), number + 1)


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string; the last digit counts once."""

    def weighed(c, i):
        return let(c.try_cast("int") * (i % 2 + 1), lambda d: F.coalesce(F.when(d > 9, d - 9).otherwise(d), F.lit(0)))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weighed), F.lit(0), lambda a, b: a + b)


def _random_digits(stream: Column, count: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
                                    lambda i: _number(stream, i, 10).cast("string")), "")


def _shift(key: str, space: Column, i: int, half: Column) -> Column:
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), space, F.lit(str(i)), half.cast("string")), 256)
    return F.conv(F.substr(digest, F.lit(1), F.lit(15)), 16, 10).cast("long")


def permuted(number: Column, a: Column, b: Column, key: str, space: Column) -> Column:
    """Another number below ``a * b``: a permutation of them that depends on the key and the
    space, whose name ends with the draw."""

    def halves(n):
        return F.struct(F.floor(n / b).alias("l"), F.pmod(n, b).alias("r"))

    def moved(state, i, sign):
        shift = lambda half: F.lit(sign) * _shift(key, space, i, half)
        return let(state, lambda s: F.struct(
            F.pmod(s["l"] + shift(s["r"]), a).alias("l"), s["r"]) if i % 2 == 0 else F.struct(
            s["l"], F.pmod(s["r"] + shift(s["l"]), b).alias("r")))

    state = halves(number)
    for i in range(4):
        state = moved(state, i, 1)
    state = let(state, lambda s: halves(F.pmod(s["l"] * b + s["r"] + 1, a * b)))
    for i in range(3, -1, -1):
        state = moved(state, i, -1)
    return let(state, lambda s: s["l"] * b + s["r"])


def _power(digits: Column) -> Column:
    return F.rpad(F.lit("1"), digits + 1, F.lit("0")).cast("long")


def _digits_moved(digits: Column, key: str, space: Column) -> Column:
    """Other digits, as many; 18 at most."""
    n = F.length(digits)
    low = F.floor(n / 2).cast("int")
    return F.when(n < 1, digits).otherwise(F.lpad(let(
        permuted(digits.cast("long"), _power(n - low), _power(low), key, space),
        lambda x: x.cast("string")), n, F.lit("0")))


def _phone(value: Column, key: str, attempt: Column) -> Column:
    """Country code, a colon and the number. Of ten digits without a code, area and exchange start
    with 2 to 9 if they did, else with what they did."""
    country, digits = F.substring_index(value, ":", 1), F.substring_index(value, ":", -1)
    draws = F.concat(F.lit("/"), attempt.cast("string"))

    def ten(d):
        part = lambda at, n: F.substr(d, F.lit(at), F.lit(n))
        usual = d.rlike(r"\A[2-9]\d\d[2-9]\d{6}\z")
        first = lambda at: F.when(usual, part(at, 1).cast("long") - 2).otherwise(0)
        a, b = F.when(usual, 800).otherwise(100).cast("long"), F.when(usual, 8_000_000).otherwise(1_000_000).cast("long")
        number = (first(1) * 100 + part(2, 2).cast("long")) * b + first(4) * 1_000_000 + part(5, 6).cast("long")
        kept = F.concat(F.when(usual, "usual").otherwise(F.concat(F.lit("phone"), part(1, 1), part(4, 1))), draws)

        def laid(x):
            l, r = F.floor(x / b), F.pmod(x, b)  # noqa: E741
            lead = lambda at, own: F.when(usual, (own + 2).cast("string")).otherwise(part(at, 1))
            return F.concat(lead(1, F.floor(l / 100)), F.lpad(F.pmod(l, F.lit(100)).cast("string"), 2, "0"),
                            lead(4, F.floor(r / 1_000_000)), F.lpad(F.pmod(r, F.lit(1_000_000)).cast("string"), 6, "0"))

        return let(permuted(number, a, b, key, kept), laid)

    abroad = F.concat(country, F.lit(":"), _digits_moved(digits, key, F.concat(F.lit("phone:"), country, F.length(digits).cast("string"), draws)))
    return F.when(country == "", F.concat(F.lit(":"), ten(digits))).otherwise(abroad)


def _card(digits: Column, key: str, attempt: Column) -> Column:
    first, n = F.substr(digits, F.lit(1), F.lit(1)), F.length(digits)
    space = F.concat_ws("/", F.lit("card"), first, n.cast("string"), attempt.cast("string"))
    body = F.concat(first, _digits_moved(F.substr(digits, F.lit(2), n - 2), key, space))
    return let(body, lambda x: F.concat(
        x, F.pmod(_luhn(digits) - _luhn(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))


def _ssn(digits: Column, key: str, attempt: Column) -> Column:
    return _digits_moved(digits, key, F.concat(F.lit("ssn/"), attempt.cast("string")))


def _ip(value: Column, key: str, attempt: Column) -> Column:
    """Another address of the same private range, or of none."""
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))

    def text(n, octets):
        return F.concat_ws(".", *[F.pmod(F.shiftright(n, 8 * i), F.lit(256)).cast("string") for i in range(octets - 1, -1, -1)])

    def address(p):
        low = lambda k: F.aggregate(F.slice(p, 5 - k, k), F.lit(0).cast("long"), lambda n, o: n * 256 + o)
        long = lambda x: F.lit(x).cast("long")
        space = lambda name: F.concat(F.lit(f"{name}/"), attempt.cast("string"))
        public = lambda n: (F.shiftright(n, 24) != 10) & (F.shiftright(n, 16) != 192 * 256 + 168)
        move = lambda n: permuted(n, long(65536), long(65536), key, space("ip"))
        # A few of a thousand addresses are private: on from there until one is not.
        walked = F.aggregate(F.sequence(F.lit(1), F.lit(32)), move(low(4)), lambda n, i: F.when(public(n), n).otherwise(move(n)))
        return F.when(value.startswith("10."), F.concat(F.lit("10."), let(
            permuted(low(3), long(256), long(65536), key, space("ip10")), lambda n: text(n, 3)))).when(
            value.startswith("192.168."), F.concat(F.lit("192.168."), let(
                permuted(low(2), long(256), long(256), key, space("ip192")), lambda n: text(n, 2)))).otherwise(
            let(walked, lambda n: text(n, 4)))

    return let(parts, address)


def _same_classes(text: Column, stream: Column) -> Column:
    """Small letters for letters and digits for digits, marks unchanged."""
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), _number(stream, i, 10).cast("string")).when(
        c.rlike("[a-z]"), F.substr(letters, _number(stream, i, 26) + 1, F.lit(1))).otherwise(c)), "")


def _email(value: Column, key: str, attempt: Column) -> Column:
    """The domain is drawn by itself, so that addresses of one domain still share one."""

    def address(local, domain):
        top = F.substring_index(domain, ".", -1)
        inner = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
        # Short addresses have few surrogates of their length, so later draws are longer.
        more = F.substr(_stream(key, "more", value, attempt), F.lit(1), F.floor(attempt / 3).cast("int") * 4)
        return F.concat(let(_stream(key, "email", value, attempt), lambda s: _same_classes(local, s)), more, F.lit("@"),
                        let(_stream(key, "domain", domain, F.lit(0)), lambda s: _same_classes(inner, s)), F.lit("."), top)

    return let(F.substring_index(value, "@", 1), lambda local: let(
        F.substring_index(value, "@", -1), lambda domain: address(local, domain)))


def _script(token: Column) -> Column:
    return F.when(token.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _coined(stream: Column, script: str, attempt: Column) -> Column:
    """A pronounceable name: four syllables and an ending, after every third draw two more."""
    syllables = SYLLABLES[script]
    parts = [_pick(syllables, _number(stream, i, len(syllables))) for i in range(1, 5)]
    more = F.transform(F.sequence(F.lit(0), F.floor(attempt / 3).cast("int") * 2),
                       lambda i: F.when(i > 0, _pick(syllables, _number(stream, i + 5, len(syllables)))).otherwise(""))
    return F.initcap(F.concat(*parts, F.array_join(more, ""), _pick(ENDINGS[script], _number(stream, 5, len(ENDINGS[script])))))


def _given(value: Column, key: str, attempt: Column) -> Column:
    """``value`` is script, gender and name; when the short list is used up a coined name is added."""

    def name(s):
        drawn = F.lit(None).cast("string")
        for script, genders in GIVEN.items():
            for gender in ("f", "m", "u"):
                pool = genders.get(gender) or genders["m"] + genders["f"]
                one = _pick(pool, _number(s, 0, len(pool)))
                full = F.when(attempt < 2, one).otherwise(F.concat_ws("-", one, _coined(s, script, attempt)))
                drawn = F.when(value.startswith(f"{script}:{gender}:"), full).otherwise(drawn)
        return drawn

    return let(_stream(key, "given", value, attempt), name)


def _family(value: Column, key: str, attempt: Column) -> Column:
    return let(_stream(key, "family", value, attempt), lambda s: F.when(
        value.startswith("cyrillic:"), _coined(s, "cyrillic", attempt)).otherwise(_coined(s, "latin", attempt)))


def _initial(value: Column, key: str, attempt: Column) -> Column:
    """Another letter of the script; initials need not be distinct."""
    letters = {"latin": "ABCDEFGHIJKLMNOPRSTUVWYZ", "cyrillic": "АБВГДЕЗИКЛМНОПРСТУФЮЯ"}
    return let(_stream(key, "initial", value, F.lit(0)), lambda s: F.concat(F.when(
        value.startswith("cyrillic:"), _pick(tuple(letters["cyrillic"]), _number(s, 0, 21))).otherwise(
        _pick(tuple(letters["latin"]), _number(s, 0, 24))), F.lit(".")))


DRAW = {"email": _email, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card, "given": _given, "family": _family,
        "initial": _initial}
LENGTHENED, MOVED = ("email", "given", "family"), ("ip", "ssn", "phone", "card")
ROUNDS = 8


def draw(kind: Column, value: Column, key: str, attempt: Column) -> Column:
    """The canonical surrogate of an entity in its ``attempt``-th draw, from 0."""
    out = F.lit(None).cast("string")
    for name, function in DRAW.items():
        out = F.when(kind == name, function(value, key, attempt)).otherwise(out)
    return out


def parsed(m: Column) -> Column:
    """What a match is: ``kind``, for names ``title`` and its ``words``, and the ``entities`` it
    mentions, one or the words of a name, as ``kind`` and canonical ``value`` (NULL for particles)."""
    entity = lambda k, v: F.struct(F.lit(k).alias("kind") if isinstance(k, str) else k.alias("kind"), v.alias("value"))
    no_words = F.lit(None).cast("array<string>")

    def phone(digits):
        north = (~m.startswith("+") & (F.length(digits) <= 13)) | (F.length(digits) == 11) & digits.startswith("1")
        grouped = F.regexp_extract(m, r"\A\+(\d{1,3})[ .()-]", 1)
        code = F.when(grouped != "", grouped).otherwise(
            F.substr(digits, F.lit(1), F.when(digits.rlike(r"\A[17]"), 1).otherwise(2)))
        return F.when(north, F.concat(F.lit(":"), F.substring(digits, -10, 10))).otherwise(
            let(code, lambda c: F.concat(c, F.lit(":"), F.substr(digits, F.length(c) + 1, F.length(digits)))))

    def plain(kind):
        digits = F.regexp_replace(m, r"\D", "")
        value = F.when(kind == "phone", let(digits, phone)).when(
            kind.isin("ssn", "card"), digits).otherwise(F.lower(m))
        return F.struct(kind.alias("kind"), F.lit(None).cast("string").alias("title"), no_words.alias("words"),
                        F.array(entity(kind, value)).alias("entities"))

    def person(title):
        rest = F.substr(m, F.length(title) + 1, F.length(m))
        gender_word = F.regexp_replace(title, r"\.? ?\z", "")
        gender = F.when(gender_word.isin(*TITLES["f"]), "f").when(gender_word.isin(*TITLES["m"]), "m").otherwise("u")
        # An initial that runs into the next word is a word of its own.
        words = F.split(F.regexp_replace(rest, r"(\p{Lu}\.)(?=\p{Lu})", "$1 "), " ")

        def entities(w):
            def one(word, i):
                named = F.concat_ws(":", _script(word), F.lower(word))
                return F.when(i == F.size(w) - 1, entity("family", named)).when(
                    word.rlike(rf"\A{_INITIAL}\z"), entity("initial", named)).when(
                    word.rlike(rf"\A{_PARTICLE}\z"), entity("particle", F.lit(None).cast("string"))).otherwise(
                    entity("given", F.concat_ws(":", _script(word), gender, F.lower(word))))

            return F.struct(F.lit("name").alias("kind"), title.alias("title"), w.alias("words"), F.transform(w, one).alias("entities"))

        return let(words, entities)

    return let(_type(m), lambda kind: F.when(
        kind == "name", let(F.regexp_extract(m, rf"\A({_TITLE}\.? |)", 1), person)).otherwise(plain(kind)))


def _laid_out(m: Column, digits: Column) -> Column:
    """Digits put into the places of a match's digits."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    put = lambda a, c: F.when(c.rlike("[0-9]"), F.struct(
        F.concat(a["out"], F.substr(digits, a["n"] + 1, F.lit(1))).alias("out"), (a["n"] + 1).alias("n"))).otherwise(
        F.struct(F.concat(a["out"], c).alias("out"), a["n"].alias("n")))
    return F.aggregate(F.split(m, ""), start, put, lambda a: a["out"])


def _cased(like: Column, name: Column) -> Column:
    return F.when((F.length(like) > 1) & (F.upper(like) == like), F.upper(name)).otherwise(name)


def replacement(m: Column, key: str, attempts: Column) -> Column:
    """The text that takes the place of a match; ``attempts`` lists redrawn entities."""

    def drawn(e):
        tries = F.transform(F.filter(attempts, lambda a: (a["kind"] == e["kind"]) & (a["value"] == e["value"])),
                            lambda a: a["attempt"])
        return let(F.coalesce(F.get(tries, F.lit(0)), F.lit(0)), lambda n: draw(e["kind"], e["value"], key, n))

    def rendered(what, new):
        name = F.concat(what["title"], F.array_join(F.zip_with(
            what["words"], new, lambda word, drawn: F.coalesce(_cased(word, drawn), word)), " "))
        first = F.get(new, F.lit(0))
        country, number = F.substring_index(first, ":", 1), F.substring_index(first, ":", -1)
        digits = F.regexp_replace(m, r"\D", "")
        before = F.when(country != "", country).otherwise(
            F.substr(digits, F.lit(1), F.greatest(F.length(digits) - 10, F.lit(0))))
        return F.when(what["kind"] == "name", name).when(
            what["kind"] == "phone", _laid_out(m, F.concat(before, number))).when(
            what["kind"].isin("ssn", "card"), _laid_out(m, first)).otherwise(first)

    return let(parsed(m), lambda what: let(
        F.transform(what["entities"], drawn), lambda new: rendered(what, new)))


def _gate(text: Column) -> Column:
    """Cheap test that every text with a match passes."""
    return F.contains(text, F.lit("@")) | text.rlike(r"\d[\d.() -]{5,}\d") | text.rlike(
        rf"{_TITLE}\.? (?:\p{{Lu}}|{_PARTICLE} )")


def _pattern(text: Column) -> Column:
    """All patterns, and the family names that the text mentions with a title, wherever they stand."""
    titled = F.regexp_extract_all(text, F.lit(PATTERNS["name"]), F.lit(0))
    families = F.array_distinct(F.transform(titled, lambda m: F.substring_index(m, " ", -1)))
    bare = F.concat(F.lit(ANY + r"|(?<![\p{L}'’-])(?:"), F.array_join(families, "|"), F.lit(r")(?![\p{L}'’-])"))
    named = text.rlike(rf"{_TITLE}\.? (?:\p{{Lu}}|{_PARTICLE} )")  # cheap, and passes every text with a titled name
    return F.when(named & (F.size(titled) > 0), bare).otherwise(F.lit(ANY))


def _matches(text: Column, pattern: Column) -> Column:
    return F.when(_gate(text), F.regexp_extract_all(text, pattern, F.lit(0)))


def redrawn(mentions: DataFrame, key: str) -> DataFrame:
    """Entities (``kind, value``) that need another draw than the first, and which: ``attempt``.

    Of entities with one surrogate the one with the fewest draws wins, then the smallest.
    """
    known = mentions.filter(F.col("kind").isin(*LENGTHENED, *MOVED)).select("kind", "value").distinct()
    table = cut_lineage(known.withColumn("attempt", F.lit(0)), "entities")
    originals = table.select("kind", F.when(
        F.col("kind").isin("given", "family"), F.substring_index("value", ":", -1)).otherwise(F.col("value")).alias("taken")).distinct()
    # A given name comes from a short list, so several may share one: family names tell apart.
    for round_ in itertools.count(1):
        tried = table.withColumn("taken", F.lower(draw(F.col("kind"), F.col("value"), key, F.col("attempt"))))
        tried = cut_lineage(tried, "draws")
        winner = tried.groupBy("kind", "taken").agg(F.min(F.struct("attempt", "value")).alias("winner"))
        judged = tried.join(winner, ["kind", "taken"]).join(
            originals.withColumn("real", F.lit(True)), ["kind", "taken"], "left")
        again = (F.col("winner.value") != F.col("value")) | F.col("real").isNotNull()
        table = cut_lineage(judged.select(
            "kind", "value", (F.col("attempt") + again.cast("int")).alias("attempt"), again.alias("again")), "entities")
        open_kinds = [r["kind"] for r in table.filter("again").select("kind").distinct().collect()]  # of seven
        if not open_kinds:
            break
        if round_ >= ROUNDS:
            # All of these keep the first permutation, by which no two meet.
            table = table.filter(~F.col("kind").isin([k for k in open_kinds if k in MOVED]))
        table = table.drop("again")
    return table.filter("attempt > 0").select("kind", "value", "attempt")


def with_surrogates(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``n_entities``, the number of mentions replaced.

    ``key`` is a secret of the run: who knows it can repeat the replacements.
    """
    if not key:
        raise ValueError("surrogates need a key")
    mentions = cut_lineage(
        docs.select("doc_id", F.explode(F.array_distinct(F.flatten(F.transform(
            _matches(F.col("text"), _pattern(F.col("text"))), lambda m: parsed(m)["entities"])))).alias("e")).select(
            "doc_id", "e.kind", "e.value"), "mentions")
    again = redrawn(mentions, key)
    # Written, so that its size is known before the join: few rows are sent to the texts.
    special = cut_lineage(mentions.join(again, ["kind", "value"]).groupBy("doc_id").agg(
        F.collect_set(F.struct("kind", "value", "attempt")).alias("attempts")).withColumnRenamed("doc_id", "__doc"),
        "redrawn")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("__id"), _pattern(F.col("text")).alias("__pattern"))
    rows = rows.join(special, F.col("__id").eqNullSafe(F.col("__doc")), "left")
    text, none = F.col("row.text"), F.array().cast("array<struct<kind:string,value:string,attempt:int>>")
    attempts = F.coalesce("attempts", none)
    pattern = F.col("__pattern")
    found = _matches(text, pattern)
    swapped = F.transform(found, lambda m: replacement(m, key, attempts))
    whole = F.array_join(F.zip_with(
        F.split(text, pattern, -1), swapped, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
    kept = [c for c in docs.columns if c not in ("text", "n_entities")]
    return rows.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept],
        F.when(F.size(found) > 0, whole).otherwise(text).alias("text"),
        F.greatest(F.coalesce(F.size(found), F.lit(0)), F.lit(0)).alias("n_entities"))
