"""Surrogates for personal data, with DataFrame functions only.

Entities are found by patterns: e-mail addresses, IPv4 and IPv6 addresses, card numbers (with a
valid check digit), phone numbers (with separators, or a plus sign before the digits) and social
security numbers, bank account numbers (in groups, or unbroken with a valid check number),
credentials, and names after a form of address.  Each mention consists of parts (an address's local part and its domain,
the words of a name), and each part gets a replacement of its own type: digits for digits, letters
for letters of the same case and script, a number with a valid check digit for one, a private
address for one, a given name of the same gender, all drawn from a keyed digest of the part in
normal form.  So the same part is replaced alike in every document, whatever its punctuation.

Distinct parts stay distinct: replacements of all parts of a type are compared, and where two are
equal, or one equals a part that occurs or a replacement settled before, all but the smallest draw
again.  Each form has a way out of a crowded space, so drawing ends: names grow by a syllable a
round, other words and numbers by a character, an address of a private block goes to a larger one
(10/8, then the reserved 240/4) and then, as IPv6 addresses in any short form do, to an IPv6 address
of full length.  Access keys are long enough as they are.  Replacements keep the mention's own
punctuation and case; a number that had to grow has its further digits at the front.

Digits of a card's length are searched as one run of groups, however long: cards with a valid check
digit in a usual grouping come first, then addresses, phone and social security numbers, and in what
lies between them cards in any grouping.

Result: every row, with ``text`` rewritten and ``n_entities``; texts without entities are returned
as they are.

Edge cases: null and empty texts stay as they are; very long texts are handled whole; repeated rows
are rewritten alike; null ids are ordinary; an empty table gives an empty one; other columns,
whatever their names, are handed through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaq.llm.common import is_empty, materialize

KEY = "surrogate-key-1"
#: Draws after which a form may grow.
GROW_AFTER = 6
#: Replacements drawn by one task.
DRAWS = 1_000

# Forms of address and given names by gender, syllables and endings of new names.
ADDRESS = {"m": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин"),
           "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Sra",
                 "Госпожа"),
           "u": ("Dr", "Prof", "Professor")}
GIVEN = {"f": ("Anna", "Maria", "Mary", "Emma", "Julia", "Laura", "Sophie", "Elena", "Marie",
               "Clara", "Sarah", "Alice", "Jane", "Susan", "Linda", "Анна", "Мария", "Елена"),
         "m": ("John", "James", "Peter", "Paul", "Thomas", "Michael", "Robert", "David", "Carlos",
               "Pierre", "Hans", "Juan", "Jean", "George", "William", "Иван", "Пётр", "Павел")}
SYLLABLES = {
    "latin": tuple(c + v for c in "bdfgklmnprstv" for v in "aeiou"),
    "cyrillic": tuple(c + v for c in "бвгдзклмнпрст" for v in "аеиоу"),
    "greek": tuple(c + v for c in "βγδκλμνπρστφχ" for v in "αειου"),
}
ENDINGS = {
    "latin": {"f": ("na", "lia", "ra", "sa"), "m": ("n", "rd", "s", "ko"),
              "u": ("l", "ri", "m", "x"), "s": ("son", "man", "ler", "ton")},
    "cyrillic": {"f": ("на", "лия", "ра", "са"), "m": ("н", "р", "с", "ко"),
                 "u": ("ль", "ри", "м", "кс"), "s": ("ский", "нов", "лев", "енко")},
    "greek": {"f": ("να", "λια", "ρα", "σα"), "m": ("ν", "ρος", "ς", "κος"),
              "u": ("λι", "ρι", "μι", "ξ"), "s": ("ίδης", "άκης", "όπουλος", "άτος")},
}
ALPHABETS = {
    "digit": "0123456789", "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "Cyrillic": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω", "Greek": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
}

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_TITLE = "(?:" + "|".join(t for g in ("f", "m", "u") for t in sorted(
    ADDRESS[g], key=len, reverse=True)) + ")"
#: Patterns in order of precedence.
PATTERNS = {
    "credential": r"(?i:(?<![a-z])(?:password|passwd|pwd|secret|api_?key|token)"
                  r"[\"']?\s{0,2}[=:]\s{0,2}[\"']?)[^\s\"'<>]{6,}",
    "access_key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
                  r"|(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}(?![A-Za-z0-9])",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+\p{L}{2,}",
    "ipv6": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
            r"|(?<![0-9A-Za-z:])(?=[0-9A-Fa-f:]*+(?![0-9A-Za-z]))(?=[A-Fa-f:]*[0-9])[0-9A-Fa-f]{4}:"
            r"(?:[0-9A-Fa-f]{1,4}:){0,5}:(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?"
            r"(?![0-9A-Za-z:])",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: [0-9A-Z]{4}){3,7}(?: [0-9A-Z]{1,3})?"
            r"(?![A-Za-z0-9])|(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}(?![A-Za-z0-9])",
    "card": r"(?<![0-9A-Za-z.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}"
             r"[ .-][0-9]{4}(?![0-9A-Za-z])|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){3,5}"
             r"(?![0-9A-Za-z])|(?<![0-9A-Za-z])\+[0-9]{8,15}(?![0-9A-Za-z])"
             r"|(?<![0-9A-Za-z.+-])0[0-9]{2,4}[ -][0-9]{3,4}[ -][0-9]{3,4}"
             r"(?![0-9A-Za-z]|[ .-][0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "person": rf"(?=[MHFSDPГ])(?<![\p{{L}}\p{{N}}]){_TITLE}\.? \p{{Lu}}[\p{{L}}’'-]+(?: \p{{Lu}}[\p{{L}}’'-]+)"
              r"{0,2}",
}
#: Where a card may begin, all the groups of digits that follow; an e-mail or IPv6 address among them
#: ends the run.
_RUN = (rf"(?={PATTERNS['card']})[0-9]++"
        r"(?:[ .-](?![0-9A-Za-z._%+-]*+@|[0-9A-Fa-f]{1,4}:[0-9A-Fa-f])[0-9]++(?![A-Za-z]))*")
#: Usual groupings of card numbers.
_CARDS = ("[0-9]{13,19}", "[0-9]{4}([ -])[0-9]{4}\\1[0-9]{4}\\1[0-9]{4}\\1[0-9]{3}",
          "[0-9]{4}([ -])[0-9]{4}\\1[0-9]{4}\\1[0-9]{4}", "[0-9]{4}([ -])[0-9]{6}\\1[0-9]{4,5}")
_IN_RUN = "|".join(f"(?:{PATTERNS[k]})" for k in ("ip", "phone", "ssn"))
_LETTER_FIRST = ("credential", "access_key", "email", "ipv6", "iban", "person")
_OTHER_FIRST = ("email", "ipv6", "ip", "card", "phone", "ssn")


def _any_of(kinds: tuple[str, ...]) -> str:
    return "(?:" + "|".join(f"(?:{_RUN if k == 'card' else p})" for k, p in PATTERNS.items()
                            if k in kinds) + ")"


#: Any entity.  None begins inside a word, so most places are passed over by the first look.
ENTITY = (rf"(?<![A-Za-z0-9])(?:(?=[\p{{L}}._%-]){_any_of(_LETTER_FIRST)}"
          rf"|(?=[0-9+(._%-]){_any_of(_OTHER_FIRST)})")
#: Every entity holds a digit, an @, a form of address before a capital, or a credential's name with
#: = or : after it.  Texts without any are passed over; the looks ahead keep the search quick.
_TITLED = rf"(?=[MHFSDPГ]){_TITLE}\.? \p{{Lu}}"
_NAMED = r"(?i:password|passwd|pwd|secret|api_?key|token)[\"']?\s{0,2}[=:]"


def hinted(text: Column) -> Column:
    return text.rlike(f"[0-9@]|{_TITLED}") | (text.rlike("[=:]") & text.rlike(_NAMED))


# ---- finding -------------------------------------------------------------------------------

def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _check_sum(number: Column) -> Column:
    """Sum of the digits as card numbers weigh them, the last digit counting once."""

    def of(digits: Column) -> Column:
        n, at = F.length(digits), lambda i: F.substring(digits, i, F.lit(1)).cast("int")
        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + F.when(
            (n - i) % 2 == 0, at(i)).otherwise(F.floor(at(i) * 2 / 10).cast("int") + at(i) * 2 % 10))

    return _let(number, of)


def _mod97(account: Column) -> Column:
    """A bank account number's remainder, its country and check digits counted last."""

    def step(rest: Column, c: Column) -> Column:
        return F.when(c < 58, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)

    codes = F.transform(F.split(account, ""), F.ascii)
    turned = F.concat(F.slice(codes, F.lit(5), F.greatest(F.size(codes) - 4, F.lit(0))),
                      F.slice(codes, 1, 4))
    return F.aggregate(F.filter(turned, lambda c: c > 0), F.lit(0), step)


def kind_of(mention: Column) -> Column:
    """The type of a mention; null for a number that is no card after all, and for a word of capitals
    and digits that is no bank account number."""
    out = None
    for kind, pattern in PATTERNS.items():
        whole = mention.rlike(f"^(?:{_bare(pattern)})$")
        value = F.lit(kind)
        if kind == "card":
            value = F.when(_check_sum(_digits(mention)) % 10 == 0, kind)
        elif kind == "iban":
            value = F.when(F.contains(mention, F.lit(" ")) | (_mod97(mention) == 1), kind)
        out = F.when(whole, value) if out is None else out.when(whole, value)
    return out


def _valid(number: Column) -> Column:
    return F.when(number != "", _check_sum(_digits(number)) % 10 == 0).otherwise(False)


def _mark_cards(run: Column) -> Column:
    """A run with a mark before and after each valid card in a usual grouping."""

    def step(s: Column, group: Column) -> Column:
        digits = _digits(group)
        start, after = s["at"] + F.length(group) - F.length(digits), s["at"] + F.length(group)
        rest = F.substring(run, start + 1, F.lit(32))
        cards = F.filter(F.array(*[F.regexp_extract(
            rest, rf"^(?:{c})(?![0-9A-Za-z]|-[0-9])", 0) for c in _CARDS]), _valid)
        card = F.when((start >= s["end"]) & ~group.rlike("^[.-]"), F.get(cards, F.lit(0)))
        end = F.coalesce(start + F.length(card), s["end"])
        return F.struct(after.alias("at"), end.alias("end"), F.concat(
            s["out"], F.substring(group, F.lit(1), F.length(group) - F.length(digits)),
            F.when(card.isNotNull(), _MARK).otherwise(""), digits,
            F.when(end == after, _MARK).otherwise("")).alias("out"))

    none = F.struct(F.lit(0).alias("at"), F.lit(0).alias("end"), F.lit("").alias("out"))
    return F.aggregate(F.regexp_extract_all(run, F.lit("[ .-]?[0-9]+"), F.lit(0)), none, step,
                       lambda s: s["out"])


def _piece(text: Column, kind: Column) -> Column:
    return F.struct(text.alias("mention"), kind.alias("kind"))


def _cut(text: Column, pattern: str, hit, between) -> Column:
    """Pieces of a text: ``hit`` of each match, ``between`` of what lies between them."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.flatten(F.transform(F.split(text, pattern, -1), lambda b, i: F.concat(
        between(b), F.when(i < F.size(hits), F.array(hit(F.get(hits, i)))).otherwise(
            F.array().cast(_PIECES)))))


_MARK = "\u0001"
_PIECES = "array<struct<mention:string,kind:string>>"


def pieces_of(mention: Column) -> Column:
    """The mention and its type; a run of groups of digits in pieces, null for what is no entity."""
    null = F.lit(None).cast("string")
    typed = lambda m: _piece(m, kind_of(m))
    loose = lambda b: _cut(b, PATTERNS["card"], typed, lambda x: F.array(_piece(x, null)))
    run = F.flatten(F.transform(F.split(_mark_cards(mention), _MARK, -1), lambda x, i: F.when(
        i % 2 == 1, F.array(_piece(x, F.lit("card")))).otherwise(_cut(x, _IN_RUN, typed, loose))))
    return F.when(mention.rlike("^[0-9](?:[ .-]?[0-9]){12,}$"), run).otherwise(
        F.array(typed(mention)))


def _bare(pattern: str) -> str:
    """A pattern without the looks around it, for a mention that stands alone."""
    import re

    return re.sub(r"\(\?<?!(?:[^()\[\]]|\[[^\]]*\])*\)", "", pattern)


def _part(before: Column, kind: Column | str, scope: Column, normal: Column, shown: Column,
          ) -> Column:
    return F.struct(before.alias("before"), (F.lit(kind) if isinstance(kind, str) else kind)
                    .alias("kind"), scope.alias("scope"), normal.alias("normal"),
                    shown.alias("shown"))


def parts_of(mention: Column, kind: Column) -> Column:
    """The parts of a mention: literal text before each, its type, scope and normal form."""
    none = F.lit("")
    local, domain = F.substring_index(mention, "@", 1), F.substring_index(mention, "@", -1)
    digits = _digits(mention)
    national = F.when((F.length(digits) == 11) & digits.startswith("1"),
                      F.substring(digits, 2, 10)).otherwise(digits)
    secret = F.regexp_extract(mention, "^(" + PATTERNS["credential"].replace(
        r"(?<![a-z])", "").replace(r"[^\s\"'<>]{6,}", "") + ")(.*)$", 2)
    title = F.substring_index(mention, " ", 1)
    words = F.slice(F.split(mention, " "), 2, 3)
    plain = F.regexp_replace(title, r"\.$", "")
    gender = F.when(plain.isin(*ADDRESS["m"]), "m").when(plain.isin(*ADDRESS["f"]), "f").when(
        words[0].isin(*GIVEN["f"]), "f").when(words[0].isin(*GIVEN["m"]), "m").otherwise("u")
    person = F.transform(words, lambda w, i: _part(
        F.when(i == 0, F.concat(title, F.lit(" "))).otherwise(F.lit(" ")),
        F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given_"), gender)),
        none, F.lower(w), w))
    return (F.when(kind == "email", F.array(
        _part(none, "local", F.lower(domain), F.lower(local), local),
        _part(F.lit("@"), "domain", none, F.lower(domain), domain)))
        .when(kind == "person", person)
        .when(kind == "credential", F.array(_part(
            F.substring(mention, F.lit(1), F.length(mention) - F.length(secret)), "credential",
            none, secret, secret)))
        .when(kind == "phone", F.array(_part(none, "phone", none, national, mention)))
        .when(kind.isin("card", "ssn"), F.array(_part(none, kind, none, digits, mention)))
        .when(kind == "iban", F.array(_part(none, kind, none, F.upper(F.replace(
            mention, F.lit(" "), F.lit(""))), mention)))
        .when(kind.isin("ip", "ipv6"), F.array(_part(none, kind, none, F.lower(mention), mention)))
        .otherwise(F.array(_part(none, kind, none, mention, mention))))


# ---- drawing replacements ------------------------------------------------------------------

def _number(h: Column, i: Column, digits: int = 2) -> Column:
    """Number i of a digest of 128 hex digits, each of so many hex digits, going round."""
    per = 128 // digits
    return F.conv(F.substring(h, (i % per) * digits + 1, F.lit(digits)), 16, 10).cast("int")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def reshape(form: Column, h: Column) -> Column:
    """A string of the same form: letters of the same case and script, digits, the rest kept."""

    def one(i: Column) -> Column:
        c, n = F.substring(form, i, F.lit(1)), _number(h, i)
        return (F.when(c.rlike("[0-9]"), _pick(ALPHABETS["digit"], n))
                .when(c.rlike("[a-zß-ÿ]"), _pick(ALPHABETS["lower"], n))
                .when(c.rlike("[A-ZÀ-Þ]"), _pick(ALPHABETS["upper"], n))
                .when(c.rlike("[а-яё]"), _pick(ALPHABETS["cyrillic"], n))
                .when(c.rlike("[А-ЯЁ]"), _pick(ALPHABETS["Cyrillic"], n))
                .when(c.rlike("[α-ωά-ώ]"), _pick(ALPHABETS["greek"], n))
                .when(c.rlike("[Α-ΩΆ-Ώ]"), _pick(ALPHABETS["Greek"], n))
                .when(c.rlike(r"\p{L}"), _pick(ALPHABETS["lower"], n)).otherwise(c))

    return F.when(F.length(form) > 0, F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(form)), one), "")).otherwise(form)


def _hex(form: Column, h: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.when(
        F.substring(form, i, F.lit(1)).rlike("[0-9a-f]"),
        _pick("0123456789abcdef", _number(h, i))).otherwise(F.substring(form, i, F.lit(1)))), "")


def _name(kind: Column, normal: Column, h: Column, extra: int) -> Column:
    """A new name: three or more syllables and an ending of the type, in the part's script."""
    out = None
    for script, test in (("cyrillic", "[а-яё]"), ("greek", "[α-ωά-ώ]"), ("latin", "")):
        syllables = F.array(*map(F.lit, SYLLABLES[script]))
        body = F.concat(*[F.get(syllables, _number(h, F.lit(i), 4) % len(SYLLABLES[script]))
                          for i in range(1, 4 + extra)])
        ending = None
        for which, values in ENDINGS[script].items():
            chosen = F.get(F.array(*map(F.lit, values)), _number(h, F.lit(0)) % len(values))
            is_it = kind == ("surname" if which == "s" else f"given_{which}")
            ending = F.when(is_it, chosen) if ending is None else ending.when(is_it, chosen)
        name = F.concat(body, ending)
        out = (F.when(normal.rlike(test), name) if out is None else
               out.otherwise(name) if script == "latin" else out.when(normal.rlike(test), name))
    return out


def draw(kind: Column, scope: Column, normal: Column, attempt: int, key: str = KEY) -> Column:
    """The replacement of a part in normal form at the given attempt."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, scope, normal, F.lit(str(attempt))), 512)
    return _let(digest, lambda h: _drawn(kind, normal, h, max(0, attempt - GROW_AFTER)))


def _drawn(kind: Column, normal: Column, h: Column, extra: int) -> Column:
    """A replacement from a digest; from ``extra`` 1 on, forms grow."""
    more = F.lit("0" * extra)
    grown = F.concat(normal, more)
    loose = reshape(grown, h)
    n = F.length(normal)
    # Numbers: the first digit of ten-digit groups is not 0 or 1; a card keeps its issuer's digit.
    lead = _pick("23456789", _number(h, F.lit(0)))
    phone = _let(loose, lambda x: F.when(n >= 10, F.concat(
        F.substring(x, n + 1, F.lit(extra)), F.substring(normal, F.lit(1), n - 10), lead,
        F.substring(x, n - 8, F.lit(2)), _pick("23456789", _number(h, F.lit(50))),
        F.substring(x, n - 5, F.lit(6)))).otherwise(
        F.concat(lead, F.substring(x, F.lit(2), n - 1 + extra))))
    payload = F.concat(F.substring(normal, 1, 1), F.substring(loose, F.lit(2), n - 2 + extra),
                       F.lit("0"))
    card = _let(payload, lambda x: F.concat(
        F.substring(x, F.lit(1), n - 1 + extra),
        ((10 - _check_sum(x) % 10) % 10).cast("string")))
    iban = _let(F.concat(F.substring(normal, 1, 2), F.lit("00"),
                         F.substring(loose, F.lit(5), n - 4 + extra)),
                lambda x: F.concat(F.substring(x, 1, 2), F.lpad(
                    (98 - _mod97(x)).cast("string"), 2, "0"),
                    F.substring(x, F.lit(5), n - 4 + extra)))
    octet = lambda i: (_number(h, F.lit(i)) % 256).cast("string")
    public = [i for i in range(1, 224) if i not in (10, 100, 127, 169, 172, 192, 198, 203)]
    first = F.get(F.array(*[F.lit(str(i)) for i in public]), _number(h, F.lit(0), 4) % len(public))
    # A block of 65,536 fills up, and so may any other: later draws are from larger ones.
    reserved = F.concat_ws(".", (_number(h, F.lit(0)) % 16 + 240).cast("string"), octet(1),
                           octet(2), octet(3))
    ten = F.concat_ws(".", F.lit("10"), octet(1), octet(2), octet(3))
    full = _hex(F.lit(":".join(["0000"] * 8)), h)
    small = normal.rlike(r"^(192\.168|169\.254|172\.(1[6-9]|2[0-9]|3[01]))\.")
    large = normal.rlike(r"^(10|127)\.")
    if extra > 2 * GROW_AFTER:
        ip = F.concat(F.lit("fd"), F.substring(full, F.lit(3), F.lit(37)))
    else:
        ip = (F.when(large, reserved if extra else F.concat_ws(
                  ".", F.substring_index(normal, ".", 1), octet(1), octet(2), octet(3)))
              .when(small, reserved if extra > GROW_AFTER else ten if extra else F.concat_ws(
                  ".", F.substring_index(normal, ".", 2), octet(2), octet(3)))
              .otherwise(F.concat_ws(".", first, octet(1), octet(2), octet(3))))
    top = F.substring_index(normal, ".", -1)
    domain = F.concat(reshape(F.concat(F.substring(normal, F.lit(1), n - F.length(top) - 1),
                                       F.lit("a" * extra)), h), F.lit("."), top)
    return (F.when(kind == "local", loose).when(kind == "domain", domain)
            .when(kind == "phone", phone).when(kind == "card", card)
            .when(kind == "ssn", F.concat(_pick("12345678", _number(h, F.lit(0))),
                                          F.substring(loose, F.lit(2), n - 1 + extra)))
            .when(kind == "ip", ip).when(kind == "ipv6", full if extra else _hex(normal, h))
            .when(kind == "iban", iban)
            .when(kind == "access_key", F.concat(F.substring(normal, 1, 4),
                                                 F.substring(loose, F.lit(5), n - 4)))
            .when((kind == "credential") & normal.rlike("^[0-9a-f]+$"), _hex(grown, h))
            .when(kind == "credential", loose)
            .otherwise(_name(kind, normal, h, extra)))


def replacements(found: DataFrame, key: str = KEY) -> DataFrame:
    """One row per distinct part (kind, scope, normal) with its replacement ``new``: no two of a
    kind and scope are equal, and none equals a part of that kind and scope.  A round draws for the
    parts still open; what it settles is not drawn or written again."""
    part, dress = ["kind", "scope", "normal"], ["kind", "scope", "new"]
    parts = materialize(found.select(part).distinct(), "parts")
    most = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = parts.select("kind", "scope", F.col("normal").alias("new"))
    settled, open_parts, left, attempt = None, parts, parts.count(), 0
    while settled is None or left:
        # A dictionary is a small file beside the texts; drawing is dealt out all the same.
        tasks = min(most, -(-left // DRAWS) or 1)
        drawn = materialize(open_parts.repartition(tasks, *part).withColumn("new", draw(
            F.col("kind"), F.col("scope"), F.col("normal"), attempt, key)), "draws")
        # Of equal replacements that are free, the smallest normal form's stays.
        done = materialize(drawn.join(taken, dress, "left_anti").groupBy(dress).agg(
            F.min("normal").alias("normal")).select(*part, "new"), "settled")
        settled = done if settled is None else settled.unionByName(done)
        taken = taken.unionByName(done.select(dress))
        open_parts = materialize(drawn.join(done, part, "left_anti").select(part), "open")
        left, attempt = open_parts.count(), attempt + 1
    return settled


def render(shown: Column, kind: Column, new: Column) -> Column:
    """A replacement in the dress of its mention: its punctuation, or its case."""
    m, k = F.length(_digits(shown)), F.length(new)

    def spread(pattern: str, count: Column) -> Column:
        """Characters of ``new`` put in place of those that match, from the right end."""
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shown)), lambda i: _spread(
            shown, i, pattern, count, new, k)), "")

    # Digits a number has grown by come before its first one; a grown account number stands unbroken.
    def grown(x: Column) -> Column:
        first = F.length(F.regexp_extract(x, "^[^0-9]*", 0))
        return F.when(k <= m, x).otherwise(F.concat(
            F.substring(x, F.lit(1), first), F.substring(new, F.lit(1), k - m),
            F.substring(x, first + 1, F.length(x))))

    compact = F.length(F.replace(shown, F.lit(" "), F.lit("")))
    upper = shown.rlike(r"^\p{Lu}[\p{Lu}’'-]+$")
    return (F.when(kind.isin("phone", "card", "ssn"), grown(spread("[0-9]", m)))
            .when((kind == "iban") & (k > compact), new)
            .when(kind == "iban", spread("[0-9A-Z]", compact))
            .when(kind.isin("surname", "given_f", "given_m", "given_u"),
                  F.when(upper, F.upper(new)).otherwise(F.initcap(new)))
            .when(kind.isin("local", "domain", "ipv6") & shown.rlike("[A-Z]")
                  & ~shown.rlike("[a-z]"), F.upper(new)).otherwise(new))


def _spread(shown: Column, i: Column, pattern: str, count: Column, new: Column, k: Column,
            ) -> Column:
    c = F.substring(shown, i, F.lit(1))
    before = F.length(F.regexp_replace(F.substring(shown, F.lit(1), i), f"[^{pattern[1:]}", ""))
    at = before - (count - k)
    return F.when(c.rlike(pattern) & (at >= 1), F.substring(new, at, F.lit(1))).otherwise(c)


# ---- rewriting -----------------------------------------------------------------------------

def replace_entities(docs: DataFrame, key: str = KEY, n_entities: str | None = None) -> DataFrame:
    """``docs`` with its texts rewritten (and ``n_chars``, where there is one, set anew); adds the
    number of entities as a column of the given name."""
    text = F.col("_row.text").cast("string")
    rows = docs.select(F.struct("*").alias("_row"))
    mentions = F.when(hinted(text), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    found = F.transform(mentions, pieces_of)
    # A generator of one row: filters cannot pull the search below it and repeat it.
    searched = rows.select("_row", F.inline(F.array(F.struct(found.alias("_found")))))
    with_any = F.coalesce(F.exists(F.flatten("_found"), lambda x: x["kind"].isNotNull()), F.lit(False))
    hits = materialize(searched.filter(with_any).select(
        "_row", "_found", F.monotonically_increasing_id().alias("_id")), "pii-texts")
    # Pieces are numbered by their mention's place and their own in it.
    place = lambda i, j: F.shiftleft(i.cast("long"), 32) + j
    each = hits.select("_id", F.posexplode("_found").alias("_i", "_m")).select(
        "_id", "_i", F.posexplode("_m").alias("_j", "_x")).select(
        "_id", place(F.col("_i"), F.col("_j")).alias("_at"), "_x.mention", "_x.kind")
    parts = materialize(each.filter("kind is not null").select(
        "_id", "_at", F.posexplode(parts_of(F.col("mention"), F.col("kind"))).alias("_k", "_p"))
        .select("_id", "_at", "_k", "_p.*"), "pii-parts")
    new = replacements(parts, key)
    renewed = parts.join(new, ["kind", "scope", "normal"]).select(
        "_id", "_at", F.struct("_k", F.concat("before", render(
            F.col("shown"), F.col("kind"), F.col("new"))).alias("s")).alias("_s"))
    # One document's entities at a time.
    by_mention = renewed.groupBy("_id", "_at").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("_s")), lambda x: x["s"]), "").alias("_new"))
    by_text = by_mention.groupBy("_id").agg(
        F.map_from_entries(F.collect_list(F.struct("_at", "_new"))).alias("_by"),
        F.count("*").alias("_count"))
    # Text between mentions, then each mention's replacement; what was no entity stays.
    joined = hits.join(by_text, "_id").select(
        "_row", "_count", "_by", F.split(text, ENTITY, -1).alias("_between"), "_found")
    rewritten = F.array_join(F.transform("_between", lambda piece, i: F.concat(
        piece, F.coalesce(F.array_join(F.transform(F.get("_found", i), lambda x, j: F.coalesce(
            F.element_at("_by", place(i, j)), x["mention"])), ""), F.lit("")))), "")
    changed = joined.select("_row", F.col("_count").cast("int").alias("_count"),
                            rewritten.alias("_text"))

    def out(frame: DataFrame, count: Column, changes: bool) -> DataFrame:
        columns = []
        for c in docs.columns:
            column = F.col("_row").getField(c)
            if changes and c == "text":
                column = F.col("_text").cast(docs.schema[c].dataType)
            elif changes and c == "n_chars":
                column = F.length("_text").cast(docs.schema[c].dataType)
            columns.append(column.alias(c))
        extra = [count.alias(n_entities)] if n_entities else []
        return frame.select(*columns, *extra)

    return out(searched.filter(~with_any), F.lit(0), False).unionByName(
        out(changed, F.col("_count"), True))


def op4_pii_surrogates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the rewritten text, and how many entities it held."""
    only = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return replace_entities(only, n_entities="n_entities")
