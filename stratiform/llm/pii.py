"""Personal data: surrogates for detected entities, with built-in functions only.

An entity is replaced by one of its own type and format.  Replacements are keyed
permutations: letters stay letters of their alphabet and case, digits stay digits,
card and account numbers keep their check digits right, given names keep gender and
script, surnames are put together from other sounds of the same kind.  An entity has the
same replacement everywhere, and two entities never share one; a check over all
replacements of the corpus confirms that, and draws anew, under a key of their own, for
those that do share one.

Persons are found by a listed given name, a title or words such as "my name is" before
the name.  Each word of a name has a replacement of its own, so that a document's other
mentions of the person, by surname or given name alone, follow the full name.
"""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import let, staged

KEY_SETTING, TEST_KEY = "stratiform.pii.key", "corpus"

# Given names by gender and script.
NAMES = {
    ("female", "latin"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Karen Sarah Nancy Margaret Sandra Ashley Emily Anna Maria Julia Sophie Claire".split(),
    ("male", "latin"): "James Robert John Michael David William Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Peter Hans Pierre Carlos Juan".split(),
    ("female", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия".split(),
    ("male", "cyrillic"): "Александр Дмитрий Сергей Андрей Алексей Иван Михаил Николай Владимир Павел".split(),
}

# What precedes a secret.
SECRET_WORDS = "password passwd pwd secret token api_key api-key apikey access_key".split()

# Titles, words before a name, and particles of surnames.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Mme Madame Monsieur Señor Señora Sr Sra г-н г-жа господин госпожа".split()
NAME_LABELS = r"my name is |signed by |(?:full|first|last|sur)[ _-]?name\s?[:=]\s{0,2}"
PARTICLES = "de del della di da dos van von der den la le".split()

# Countries whose account numbers are found.
IBAN_COUNTRIES = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LT LU LV MT NL NO PL PT RO SE SI SK".split()

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_GROUP = r"[0-9A-Fa-f]{1,4}"
_GIVEN = [n for names in NAMES.values() for n in names]
# A word of a name (Smith, O'Brien, McDonald), in capitals, and a surname of such words.
_WORD = r"(?:\p{Lu}['’])?\p{Lu}\p{L}*\p{Ll}"
_CAPITALS = r"(?:\p{Lu}['’])?\p{Lu}{2,}"
_INITIALS = r"(?: \p{Lu}\.){0,2}"
_SURNAME = f"(?:(?:{'|'.join(PARTICLES)}) ){{0,2}}{_WORD}(?:-{_WORD})*"
_TITLED = f"(?:(?:{'|'.join(TITLES)})\\.? ){{1,2}}"
_START, _END = r"(?<!\p{L})", r"(?!\p{L})"
PATTERNS = {
    "secret": r"\b(?i:" + "|".join(SECRET_WORDS) + r")\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_/+.-]{7,}[A-Za-z0-9_/+-]",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "ipv6": rf"(?<![\w:])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?i:[23][0-9a-f]{{3}}|fe[89ab][0-9a-f]|f[cd][0-9a-f]{{2}})(?::{_GROUP}){{0,6}}::(?:{_GROUP}(?::{_GROUP}){{0,5}})?)(?![\w:])",
    "iban": r"(?<![A-Za-z0-9])(?:" + "|".join(IBAN_COUNTRIES) + r")\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?!\.?\d)",
    "card": r"(?<!\d)(?:(?:4\d{3}|5[1-5]\d{2}|2[2-7]\d{2}|6011|65\d{2})(?:[ -]?\d{4}){3}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])|(?<!\p{L})(?i:ssn|social security(?: number| no\.?)?)[ :#=]{1,3}\d{3} ?\d{2} ?\d{4}(?!\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\d)"
    r"|(?<![\w+])(?<!\d )[2-9]\d{2} [2-9]\d{2} \d{4}(?! ?\d)"
    r"|(?<!\p{L})(?i:(?:phone|telephone|tel|mobile|cell|fax)(?: no| number)?)[.:]{0,2} {0,2}\d{10,11}(?!\d)",
    "name": rf"{_START}(?=\p{{Lu}})(?:{'|'.join(_GIVEN)})(?:-{_WORD})?{_INITIALS} {_SURNAME}{_END}"
    rf"|{_START}(?=\p{{Lu}}{{2}})(?:{'|'.join(n.upper() for n in _GIVEN)}){_INITIALS} {_CAPITALS}(?:-{_CAPITALS})*{_END}"
    rf"|{_START}{_TITLED}(?:{_WORD} )?(?:\p{{Lu}}\. ){{0,2}}{_SURNAME}{_END}"
    rf"|{_START}(?i:{NAME_LABELS}){_WORD}(?:-{_WORD})*(?: {_SURNAME}){{0,2}}{_END}",
}
TYPES = tuple(PATTERNS)


def _firsts(words: list[str]) -> str:
    """First letters of words, of both cases."""
    return "".join(sorted({c for w in words for c in (w[0].lower(), w[0].upper())}))


# What a match of each type may begin with.  Hardly any place of a text is such a place,
# and the patterns are tried at no other.
BEGINNINGS = {
    "secret": _firsts(SECRET_WORDS),
    "key": "A",
    "email": "A-Za-z0-9._%+-",
    "ipv6": "0-9A-Fa-f",
    "iban": "A-Z",
    "ip": "0-9",
    "card": "2-6",
    "ssn": "0-9Ss",
    "phone": "0-9(+" + _firsts("phone tel mobile cell fax".split()),
    "name": "".join(sorted({w[0] for w in (*_GIVEN, *TITLES)} | {*_firsts("my signed full first last sur".split())})),
}
# No match begins between two small letters, nor with a space or a comma.
_INSIDE = "(?<![a-z](?=[a-z]))"
_BEGINS = f"(?=[A-Za-z0-9._%+(\\-{''.join(c for c in BEGINNINGS['name'] if not c.isascii())}])"
ANY = f"{_INSIDE}{_BEGINS}(?:{'|'.join(f'(?=[{BEGINNINGS[t]}])(?:{p})' for t, p in PATTERNS.items())})"
# In documents with names: also every capitalised word, which may be a mention of one.
MENTION = rf"{_START}(?:\p{{Lu}}['’])?\p{{Lu}}\p{{L}}{{2,}}{_END}"
ANY_OR_MENTION = f"{ANY}|{MENTION}"
_NAME_PREFIX = f"^((?i:{NAME_LABELS})|{_TITLED})"

# Replacements that are drawn anew in a round; the rest comes in the next one.
DRAWN_PER_ROUND = 10_000
# After so many draws of a surname its shape has no room left, and it grows.
CRAMPED = 8

_DIGITS = ("0123456789",)
_PLAIN = (*_DIGITS, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
# Digits that may and that may not begin an area code stay apart.
_DIALLED = ("01", "23456789")
_SPOKEN = (
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "АЕИОУЭЮЯ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
)
_HEX = ("0123456789abcdef",)
# Sounds of more than a letter: before a vowel, anywhere, and not before a vowel.
_ONSETS = tuple("bl br cl cr dr fl fr gl gr kn pl pr sl sm sn sw tr".split())
_EITHER = tuple("ch sh sk sp st th".split())
_CODAS = tuple("ck ff ld ll lt mp nd ng nk nn nt rd rk rl rm rn rt ss tt".split())
_SOUND = f"(?i:(?:{'|'.join(_ONSETS)})(?=[aeiouy])|{'|'.join(_EITHER)}|(?:{'|'.join(_CODAS)})(?![aeiouy])|.)"
_SOUNDS = (_ONSETS, _EITHER, _CODAS, "aeiou", "bcdfghjklmnprstvwz", "qx", "AEIOU", "BCDFGHJKLMNPRSTVWZ", "QX", *_SPOKEN[4:])
# Endings of Cyrillic surnames, which tell the gender.
_ENDING = r"^(\p{IsCyrillic}{2,}?)((?iu:ов|ев|ёв|ин|ын|ова|ева|ёва|ина|ына|ский|ская|цкий|цкая))$"

# Letters with several forms of one case (the Kelvin sign; final sigma), and the form taken.
_FORMS = ("\u212aΣς", "Kσσ")


def _number(*parts: Column) -> Column:
    """A number below 2**40 that a keyed digest gives for the parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 10), 16, 10).cast("long")


def _tag(key: str | Column, rest: str) -> Column:
    return F.lit(key + rest) if isinstance(key, str) else F.concat(key, F.lit(rest))


def _moved(c: Column, by: Column, alphabet: str | tuple[str, ...]) -> tuple[Column, Column]:
    """Whether ``c`` is in the alphabet (of letters, or of sounds in any case), and what follows it there."""
    if isinstance(alphabet, str):
        at = F.instr(F.lit(alphabet), c)
        return (at > 0) & (F.length(c) == 1), F.substring(F.lit(alphabet), (F.pmod(at - 1 + by, F.lit(len(alphabet))) + 1).cast("int"), 1)
    sounds = F.array(*(F.lit(x) for x in alphabet))
    at = F.array_position(sounds, F.lower(c))
    new = F.element_at(sounds, (F.pmod(at - 1 + by, F.lit(len(alphabet))) + 1).cast("int"))
    return at > 0, F.when(c == F.lower(c), new).when(c == F.upper(c), F.upper(new)).otherwise(F.initcap(new))


def _shift(units: Column, other: Column, label: Column, alphabets: tuple) -> Column:
    """Move every letter or sound along its alphabet by an amount that ``other`` determines."""

    def move(c: Column, i: Column) -> Column:
        by = _number(label, F.lower(F.array_join(other, "")), i.cast("string"))
        out = c
        for alphabet in alphabets:
            inside, new = _moved(c, by, alphabet)
            out = F.when(inside, new).otherwise(out)
        return F.when(c == "", c).otherwise(out)

    return F.transform(units, move)


def _rounds(left: Column, right: Column, key: str | Column, label: str, alphabets: tuple, rounds: int = 4) -> Column:
    """``left || right``, arrays, with both permuted; the alphabets of all places stay.

    Each round shifts one half by what the other one holds, so it can be undone: the
    whole is a permutation of the texts of this shape.
    """

    def step(k: int) -> Callable[[Column], Column]:
        def apply(state: Column) -> Column:
            a, b = state["a"], state["b"]
            tag = _tag(key, f"\x1f{label}\x1f{k}")
            done = F.struct(_shift(a, b, tag, alphabets).alias("a"), b.alias("b")) if k % 2 == 0 else F.struct(a.alias("a"), _shift(b, a, tag, alphabets).alias("b"))
            return done if k == rounds - 1 else let(done, step(k + 1))

        return apply

    state = F.struct(left.alias("a"), right.alias("b"))
    return let(let(state, step(0)), lambda s: F.concat(F.array_join(s["a"], ""), F.array_join(s["b"], "")))


def _permuted(left: Column, right: Column, key: str | Column, label: str, alphabets: tuple) -> Column:
    return _rounds(F.split(left, ""), F.split(right, ""), key, label, alphabets)


def _halves(value: Column, key: str | Column, label: str, alphabets: tuple[str, ...]) -> Column:
    half = (F.length(value) / 2).cast("int")
    return _permuted(F.substring(value, F.lit(1), half), F.substring(value, half + 1, F.length(value)), key, label, alphabets)


def _email(e: Column, key: str | Column) -> Column:
    """Reserved example domains stay; of others all but the last label is permuted."""
    local, domain = F.substring_index(e, "@", 1), F.substring_index(e, "@", -1)
    stem = F.regexp_extract(domain, r"^(.*)\.[^.]*$", 1)
    moved = F.concat(_halves(stem, key, "domain", _PLAIN), F.lit("."), F.substring_index(domain, ".", -1))
    domain = F.when(F.lower(domain).rlike(r"(^|\.)example\.(com|org|net)$"), domain).otherwise(moved)
    return F.concat(_halves(local, key, "email", _PLAIN), F.lit("@"), domain)


def _ip(e: Column, key: str | Column) -> Column:
    """Octets with a leading zero keep it; others have none."""

    def step(k: int, a: Column, b: Column, o: Column) -> Column:
        if k == 4:
            values = (F.floor(a / o[1]["m"]), a % o[1]["m"], F.floor(b / o[3]["m"]), b % o[3]["m"])
            texts = (F.when(x["m"] == 256, v.cast("string")).otherwise(F.concat(F.lit("0"), v.cast("string"))) for x, v in zip((o[i] for i in range(4)), values))
            return F.concat_ws(".", *texts)
        by = _number(_tag(key, f"\x1fip\x1f{k}"), b.cast("string"))
        moved = F.pmod(a + by, o[0]["m"] * o[1]["m"]) if k % 2 == 0 else F.pmod(a + by, o[2]["m"] * o[3]["m"])
        # After a step the halves change places; after four they are back in theirs.
        done = F.struct(b.alias("a"), moved.alias("b"))
        return let(done, lambda s: step(k + 1, s["a"], s["b"], o))

    def octet(x: Column) -> Column:
        # How many values there are of this shape: 00..09 or 0..255.
        return F.struct(x.cast("long").alias("v"), F.when(x.rlike("^0."), 10).otherwise(256).cast("long").alias("m"))

    octets = F.transform(F.split(e, "\\."), octet)
    return let(octets, lambda o: step(0, o[0]["v"] * o[1]["m"] + o[1]["v"], o[2]["v"] * o[3]["m"] + o[3]["v"], o))


def _luhn(payload: Column) -> Column:
    """The check digit of a row of digits."""
    digits = F.transform(F.split(F.reverse(payload), ""), lambda c, i: F.when(i % 2 == 0, (c.cast("int") * 2)).otherwise(c.cast("int")))
    total = F.aggregate(digits, F.lit(0), lambda acc, d: acc + F.when(d > 9, d - 9).otherwise(d))
    return F.pmod(-total, F.lit(10))


def _card(e: Column, key: str | Column) -> Column:
    """Issuer digits stay, the others are permuted; the check digit is as right as it was."""
    plain = F.regexp_replace(e, "[^0-9]", "")

    def whole(d: Column) -> Column:
        issuer, own = F.substring(d, 1, 2), F.substring(d, F.lit(3), F.length(d) - 3)
        off = F.substring(d, -1, 1).cast("int") - _luhn(F.substring(d, F.lit(1), F.length(d) - 1))
        moved = F.concat(issuer, _halves(own, key, "card", _DIGITS))
        return let(moved, lambda m: F.concat(m, F.pmod(_luhn(m) + off, F.lit(10)).cast("string")))

    def spaced(digits: Column) -> Column:
        return _laid_out(e, digits, "[0-9]")

    return let(let(plain, whole), spaced)


def _laid_out(e: Column, value: Column, kind: str) -> Column:
    """``value`` in place of the characters of ``e`` that are of a kind; the others stay."""
    seen = lambda i: F.length(F.regexp_replace(F.substring(e, F.lit(1), i), f"[^{kind[1:]}", ""))
    return F.array_join(F.transform(F.split(e, ""), lambda c, i: F.when(c.rlike(kind), F.substring(value, seen(i + 1), F.lit(1))).otherwise(c)), "")


def _remainder(value: Column) -> Column:
    """The remainder by 97 of digits and letters, which stand for 10 to 35."""

    def add(acc: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(value, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(add(acc, c)))


def _iban(e: Column, key: str | Column) -> Column:
    """The country stays; right check digits are right again, and wrong ones stay."""

    def whole(v: Column) -> Column:
        country, check, own = F.substring(v, 1, 2), F.substring(v, 3, 2), F.substring(v, F.lit(5), F.length(v))
        right = _remainder(F.concat(own, country, check)) == 1

        def checked(m: Column) -> Column:
            fresh = F.lpad((98 - _remainder(F.concat(m, country, F.lit("00")))).cast("string"), 2, "0")
            return F.concat(country, F.when(right, fresh).otherwise(check), m)

        return let(_halves(own, key, "iban", (*_DIGITS, _PLAIN[2])), checked)

    return let(let(F.regexp_replace(e, " ", ""), whole), lambda v: _laid_out(e, v, "[0-9A-Z]"))


def _ipv6(e: Column, key: str | Column) -> Column:
    """The first group, which tells the kind of address, stays."""
    first = F.regexp_extract(e, "^([^:]*:)", 1)
    rest = F.substring(e, F.length(first) + 1, F.length(e))
    moved = _halves(F.lower(rest), key, "ipv6", _HEX)
    return F.concat(first, let(moved, lambda m: F.when(rest == F.upper(rest), F.upper(m)).otherwise(m)))


def _ssn(e: Column, key: str | Column) -> Column:
    before = F.regexp_extract(e, r"^(\D*)", 1)
    return F.concat(before, _halves(F.substring(e, F.length(before) + 1, F.length(e)), key, "ssn", _DIGITS))


def _phone(e: Column, key: str | Column) -> Column:
    """The country code stays, and so does the exchange 555, whose numbers nobody has."""
    country = F.regexp_extract(e, r"^([^+(\d]*(?:\+\d{1,3}[ .-]?)?)", 1)
    rest = F.substring(e, F.length(country) + 1, F.length(e))
    shape = r"^(\(?\d{3}\)?[ .-]{0,2})(555)([ .-]\d{4})$"

    def general(r: Column) -> Column:
        once = lambda v: _halves(v, key, "phone", _DIALLED)
        # Numbers that would get the exchange 555 go on to the next of their cycle.
        return let(once(r), lambda x: F.when(x.rlike(shape), once(x)).otherwise(x))

    def either(r: Column) -> Column:
        a, b, c = (F.regexp_extract(r, shape, i) for i in (1, 2, 3))
        # Rounds of the halves around the exchange, which is put back between them.
        both = let(_permuted(a, c, key, "phone555", _DIALLED), lambda x: F.concat(F.substring(x, F.lit(1), F.length(a)), b, F.substring(x, F.length(a) + 1, F.length(x))))
        return F.when(r.rlike(shape), both).otherwise(general(r))

    return F.concat(country, let(rest, either))


def _secret(e: Column, key: str | Column) -> Column:
    before = F.regexp_extract(e, r"^([^=:]*[=:]\s*[\"']?)", 1)
    value = F.substring(e, F.length(before) + 1, F.length(e))

    def hexed(v: Column) -> Column:
        # Case variants are one secret: its digits are those of the lower-cased value.
        moved = _halves(F.lower(v), key, "hex", _HEX)
        return let(moved, lambda m: F.when(v.rlike("[A-F]") & ~v.rlike("[a-f]"), F.upper(m)).otherwise(m))

    moved = let(value, lambda v: F.when(v.rlike("^[0-9A-Fa-f]+$"), hexed(v)).otherwise(_halves(v, key, "secret", _PLAIN)))
    return F.concat(before, moved)


def _circles(key: str) -> Column:
    """Each given name with the next one on a keyed circle through its group."""
    pairs = []
    for group, names in NAMES.items():
        circle = names[:]
        random.Random(f"{key}|{group}").shuffle(circle)
        pairs += [F.lit(x) for i, n in enumerate(circle) for x in (n, circle[(i + 1) % len(circle)])]
    return F.create_map(*pairs)


def _surname(word: Column, key: str | Column) -> Column:
    """Other sounds of the same kinds; a Cyrillic ending stays."""

    def other(w: Column) -> Column:
        sounds = F.regexp_extract_all(w, F.lit(_SOUND), F.lit(0))
        return let(sounds, lambda u: _rounds(F.slice(u, F.lit(1), (F.size(u) / 2).cast("int")), F.slice(u, (F.size(u) / 2).cast("int") + 1, F.size(u) + 1), key, "surname", _SOUNDS))

    ending = F.regexp_extract(word, _ENDING, 2)
    return F.concat(other(F.substring(word, F.lit(1), F.length(word) - F.length(ending))), ending)


def _name(e: Column, key: str | Column, circles: str) -> Column:
    """Titles and particles stay; every other word is replaced by itself.

    The last word counts as a surname unless it stands alone.
    """
    prefix = F.regexp_extract(e, _NAME_PREFIX, 1)

    def word(t: Column, i: Column, last: Column) -> Column:
        core = F.regexp_extract(t, "^([^ -]*)", 1)

        def replaced(given: Column) -> Column:
            named = F.when(core == F.upper(core), F.upper(given)).otherwise(given)
            new = F.when(given.isNotNull() & ((i < last) | (last == 0)), named).when(core.rlike(r"^\p{Ll}"), core).otherwise(_surname(core, key))
            return F.concat(new, F.substring(t, F.length(core) + 1, F.length(t)))

        return let(F.element_at(_circles(circles), F.initcap(core)), replaced)

    words = F.split(F.substring(e, F.length(prefix) + 1, F.length(e)), "(?<=[ -])")
    return F.concat(prefix, let(words, lambda w: F.array_join(F.transform(w, lambda t, i: word(t, i, F.size(w) - 1)), "")))


def _mentions(names: Column) -> Column:
    """Words, in small letters, by which the persons may be mentioned alone."""
    words = F.flatten(F.transform(names, lambda e: F.split(F.regexp_replace(e, _NAME_PREFIX, ""), "[ -]")))
    return F.array_distinct(F.transform(F.filter(words, lambda w: w.rlike(f"^{MENTION}$")), F.lower))


def entity_type(e: Column) -> Column:
    """The first type whose pattern matches the whole entity; a lone word is a name."""
    out = F.lit("name")
    for kind in reversed([t for t in TYPES if t != "name"]):
        out = F.when(e.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def surrogate(e: Column, kind: Column, key: str, own: Column | None = None) -> Column:
    """The replacement under ``key``, or under a key of the entity's ``own``.

    Given names keep their circles under any key of its own: only surnames are drawn anew.
    """
    name = lambda x, k: _name(x, k, key)
    makers = {
        "secret": _secret, "email": _email, "ip": _ip, "ipv6": _ipv6, "iban": _iban, "card": _card, "phone": _phone,
        "ssn": _ssn, "name": name, "given": name,
        "key": lambda x, k: F.concat(F.lit("AKIA"), _halves(F.substring(x, 5, 16), k, "key", _PLAIN)),
    }
    out = e
    for kind_of, make in makers.items():
        out = F.when(kind == kind_of, make(e, key if own is None else own)).otherwise(out)
    return out


def key_of(spark: SparkSession) -> str:
    """The secret key of the session, under ``KEY_SETTING``.

    The replacements can be undone by anybody who has the key.  Without the setting a key
    is taken that is public, for tests and made-up data.
    """
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def _folded(e: Column) -> Column:
    return F.lower(F.translate(e, *_FORMS))


def _digest(e: Column, key: str) -> Column:
    return F.sha2(F.concat(F.lit(key), _folded(e)), 256)


def _entity(e: Column, mentions: Column, key: str) -> Column:
    """An entity with its type (null: a capitalised word that is no mention) and replacement.

    ``part`` is the digest of what is drawn anew where replacements collide: of names
    the surname, so that all who have it follow.
    """
    lone = e.rlike(f"^{MENTION}$")
    mentioned = F.when(~F.array_contains(mentions, F.lower(e)), F.lit(None).cast("string")).when(
        F.initcap(F.translate(e, *_FORMS)).isin(*_GIVEN), F.lit("given")
    ).otherwise(F.lit("name"))

    def typed(t: Column) -> Column:
        drawn = F.when(t == "name", F.regexp_extract(e, "([^ ]*)$", 1)).otherwise(e)
        new = F.when(t.isNull(), e).otherwise(surrogate(F.translate(e, *_FORMS), t, key))
        digests = (F.when(t.isNotNull(), _digest(x, key)) for x in (e, drawn))
        return F.struct(e.alias("raw"), t.alias("type"), *(d.alias(n) for n, d in zip(("digest", "part"), digests)), F.lit(0).alias("draw"), new.alias("surrogate"))

    return let(F.when(lone, mentioned).otherwise(entity_type(e)), typed)


def _protected(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``_woven`` in place of the text: its entities and what lies between them."""
    text = F.col("text")

    def cut(found: Column, gaps: Column, mentions: Column) -> Column:
        return F.struct(found.alias("found"), gaps.alias("gaps"), mentions.alias("mentions"))

    def pieces(found: Column) -> Column:
        names = F.filter(found, lambda e: e.rlike(f"^(?:{PATTERNS['name']})$"))
        named = cut(F.regexp_extract_all(text, F.lit(ANY_OR_MENTION), F.lit(0)), F.split(text, ANY_OR_MENTION), _mentions(names))
        gaps = F.when(F.size(found) > 0, F.split(text, ANY)).otherwise(F.array(text))
        return F.when(F.size(names) > 0, named).otherwise(cut(found, gaps, F.array().cast("array<string>")))

    def woven(c: Column) -> Column:
        return F.struct(c["gaps"].alias("gaps"), F.transform(c["found"], lambda e: _entity(e, c["mentions"], key)).alias("entities"))

    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return docs.withColumn("_woven", F.when(text.isNotNull(), let(let(found, pieces), woven))).drop("text")


def _drawn_anew(protected: DataFrame, key: str, parts: list[str]) -> DataFrame:
    """Rows that hold one of ``parts``, with another replacement of each of them."""

    def other(x: Column) -> Column:
        draw = x["draw"] + 1

        def drawn(own: Column) -> Column:
            new = surrogate(F.translate(x["raw"], *_FORMS), x["type"], key, own)
            longer = F.concat(new, F.translate(draw.cast("string"), "0123456789", "aeioulmnrs"))
            return x.withField("draw", draw).withField("surrogate", F.when((x["type"] == "name") & (draw > CRAMPED), longer).otherwise(new))

        return F.when(x["part"].isin(parts), let(F.concat(F.lit(key + "#"), draw.cast("string")), drawn)).otherwise(x)

    rows = protected.where(F.exists("_woven.entities", lambda x: x["part"].isin(parts)))
    return rows.withColumn("_woven", F.col("_woven").withField("entities", F.transform("_woven.entities", other)))


def _pairs(entities: DataFrame) -> DataFrame:
    # Case variants of an entity count as one; so do those of its replacement.
    return (
        entities.select(F.explode("_entities").alias("e"))
        .where("e.type IS NOT NULL")
        .select("e.type", "e.digest", "e.part", F.lower("e.surrogate").alias("surrogate"))
        .distinct()
    )


def collisions(protected: DataFrame) -> DataFrame:
    """Replacements that stand for more than one entity, and entities with more than one."""
    pairs = _pairs(protected)
    shared = pairs.groupBy("type", "surrogate").agg(F.count("*").alias("n")).where("n > 1").select("type", F.col("surrogate").alias("value"))
    split = pairs.groupBy("type", "digest").agg(F.count("*").alias("n")).where("n > 1").select("type", F.col("digest").alias("value"))
    return shared.unionAll(split)


def _crowded(protected: DataFrame) -> list[str]:
    """Parts of entities that have to give up a replacement to one with a smaller digest.

    At most ``DRAWN_PER_ROUND`` of them go through the driver.  Replacements of one shape
    are permutations, so there are few.  Given names alone share none.
    """
    pairs = _pairs(protected.select(F.col("_woven.entities").alias("_entities")))
    first = pairs.groupBy("type", "surrogate").agg(F.min("digest").alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = pairs.join(first, ["type", "surrogate"]).where("digest <> first AND type <> 'given'")
    return [r["part"] for r in rows.select("part").distinct().orderBy("part").limit(DRAWN_PER_ROUND).collect()]


def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every detected entity in ``text`` replaced, and ``_entities``.

    The result is written once; the check for collisions reads its entities alone.  If
    entities share a replacement, one of them keeps it and the others are drawn anew
    until none do; the texts are not searched again.  A null or
    empty text stays as it is, with no entities; so does any text without an entity, to
    the byte.  Rows are treated one by one: order, ties and repeated rows don't matter,
    and other columns are kept, whatever their names (``_entities`` and ``_woven``
    excepted).
    """
    done = staged(_protected(docs, key), "protected")
    while parts := _crowded(done):
        rest = done.where(~F.coalesce(F.exists("_woven.entities", lambda x: x["part"].isin(parts)), F.lit(False)))
        done = staged(rest.unionByName(_drawn_anew(done, key, parts)), "protected")
    entities = F.filter("_woven.entities", lambda x: x["type"].isNotNull())
    text = F.array_join(F.zip_with("_woven.gaps", "_woven.entities", lambda gap, x: F.concat(gap, F.coalesce(x["surrogate"], F.lit("")))), "")
    columns = [text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns]
    public = F.transform(entities, lambda x: F.struct(x["type"].alias("type"), x["digest"].alias("digest"), x["part"].alias("part"), x["surrogate"].alias("surrogate")))
    return done.select(*columns, F.coalesce(public, F.array().cast("array<struct<type:string,digest:string,part:string,surrogate:string>>")).alias("_entities"))


def counts(protected: DataFrame) -> dict[str, Column]:
    """For each type, how many entities a document holds; mentions are names."""

    def of(kind: str) -> Column:
        kinds = ("name", "given") if kind == "name" else (kind,)
        return F.size(F.filter("_entities", lambda e: e["type"].isin(*kinds))).cast("long")

    return {f"n_{t}": of(t) for t in TYPES}
