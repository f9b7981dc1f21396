"""Replacing personal data by keyed surrogates, with DataFrame functions only.

One pattern finds entities: secrets (with a digit) after a naming word, e-mail addresses,
persons after a title and their names elsewhere in the text, IP addresses, phone numbers, social security and card
numbers (Luhn, also next to other numbers).  An entity consists of units that can recur in others (the
words of a name, the local part and host of an address, the digits of a
number).  A unit's surrogate is a function of key, kind, unit and attempt:
type-consistent (valid octets, Luhn digit), of the same script and, for given
names, the gender of the title (of any of the corpus where a title says none).
Initials are moved on in the alphabet by family name.  Units that share a surrogate, or whose
surrogate is some other unit of the corpus, are tried again with the next
attempt until all are distinct, so replacements stay one to one and every
mention of a unit gets the same one.  Later attempts lengthen what has no
fixed length, so short units run out of room at no size of corpus.

Texts are rewritten in place where every unit is at its first attempt; only
texts that hold one of the few others are joined with their attempts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from triplake.lake import scratch_dir
from triplake.llm.common import stored, table

KEY = "corpus"

# Titles and the gender they say, words that stand before family names, naming words of secrets.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа")
NEUTRAL = ("Dr", "Prof")
PARTICLES = ("von", "van", "vom", "zu", "zum", "zur", "der", "den", "dem", "de", "del", "della", "di", "da", "dos", "das", "do",
             "du", "la", "le", "los", "ter", "ten", "op", "bin", "ibn", "al", "el", "y")
SECRET_WORDS = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey")

#: Attempts at a unit's own length; each later one is a character longer.
SAME_LENGTH = 8
#: Attempts after which numbers of a fixed format are taken to have no room left.
ROUNDS = 1000
#: Bits of the filter of texts that are joined with later attempts, as a power of two, at most.
MOST_SLOTS = 25

# First digits of payment cards.
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[045678]|6(011|2|4[4-9]|5))"

_B, _E = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_SPACE = r"[ \t\u00A0]"
_AFTER = r"(?:" + _SPACE + r"{1,3}|" + _SPACE + r"{0,3}\r?\n" + _SPACE + r"{0,3})"
_INITIAL = r"\p{Lu}\.(?:" + _AFTER + r")?"
_TITLE = r"(?:" + "|".join(MALE + FEMALE + NEUTRAL) + r")\.?"
_NAMED = r"(?i:" + "|".join(SECRET_WORDS) + r")\s{0,3}[=:]\s{0,3}[\"']?"
SECRET = _B + _NAMED + r"[^\s\"'`<>,;]{3,}[^\s\"'`<>,;.:!?]"
# a word is tried from its first character only and never given back; a host's labels are as many and as long as names
# of hosts may have: a repeat without a bound is a call a label deep
EMAIL = (r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]{1,63}(?:\.[\p{L}\p{N}-]{1,63}){0,125}"
         r"\.\p{L}{2,63}(?![\p{L}\p{N}])")
# titles in a row, and small words that stand before a name
_TITLES = _TITLE + r"(?:" + _AFTER + _TITLE + r"){0,3}"
_BEFORE = r"(?:(?:" + "|".join(PARTICLES) + r")" + _SPACE + r"{1,3}){0,3}"
PERSON = (_B + _TITLES + _AFTER + r"(?:" + _INITIAL + r"|\p{Lu}" + _AFTER + r"){0,3}" + _BEFORE + _NAME
          + r"(?:" + _SPACE + r"{1,3}(?:" + _INITIAL + r"){0,3}" + _BEFORE + _NAME + r"){0,2}")
_WORD = r"\p{Lu}[\p{L}'’-]*"
IP = r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?!\p{N}|\.\d)"
PHONE = (_B + r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}" + _E + "|"
         + _B + r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}" + _E + "|"
         + r"(?<![\p{L}\p{N}.-])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}" + _E)
SSN = r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"
# a run of groups of digits: cards, and phone and social security numbers next to other numbers, are sought in it
_GROUP = r"\d++(?![\p{L}\p{N}])"
CARD = _B + r"(?=(?:[ -]?\d){13})" + _GROUP + r"(?:[ -]" + _GROUP + r")*+"
# in a run, from the border of a group to another's
_CARDS = (r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}", r"\d{4}[ -]?\d{6}[ -]?\d{4,5}", r"\d{13,19}",
          r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,3}")
_FIRST = r"\d(?:[ -]?\d){12,18}"
_OTHERS = (r"\d{3}[ -]\d{3}[ -]\d{4}", r"\d{3}-\d{2}-\d{4}(?!-)")
_WINDOW = 40
ENTITY = "|".join((SECRET, EMAIL, PERSON, IP, PHONE, SSN, CARD))

_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALPHABETS = ((r"[0-9]", "0123456789"), (r"[a-z]", _LOWER), (r"[A-Z]", _UPPER),
              (r"\p{IsCyrillic}", "абвгдежзиклмнопрстуфхцчшэюя"), (r"\p{IsGreek}", "αβγδεζηθικλμνξοπρστυφχψω"),
              (r"\p{IsLatin}", _LOWER), (r"\p{L}", _LOWER), (r"\p{N}", "0123456789"))
_SYLLABLES = {"latin": "bal ber dan del dor fal fen gar gel hal hem jor kal kel lan lor mar mel mor nal nor pal per "
                       "ral ren sal sel tal ter val ver wil",
              "cyrillic": "бал бер дан дел дор фал фен гар гел лан лор мар мел мор нал нор пал пер рал рен сал сел "
                          "тал тер вал вер кал кел жан зор тим рус",
              "greek": "βαλ βερ δαν δελ δορ φαλ φεν γαρ γελ λαν λορ μαρ μελ μορ ναλ νορ παλ περ ραλ ρεν σαλ σελ "
                       "ταλ τερ θαλ θερ καλ κελ ζαν ζορ τιμ ρουσ"}
_ENDINGS = {"latin": ("o", "a", "is"), "cyrillic": ("ов", "ова", "ин"), "greek": ("ος", "α", "ις")}


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then).getItem(0)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _chars(c: Column) -> Column:
    return F.split(c, "")


def _rest(c: Column, first: int) -> Column:
    return c.substr(F.lit(first), F.length(c))


def _national(m: Column) -> Column:
    """A phone number's digits, ten at most from the end, without the country code that a + says."""
    code = F.regexp_extract(m, r"^\+(1(?!\d)|1(?=\d{10}$)|\d{1,3}(?!\d)|\d{2})", 1)
    return F.right(_rest_after(_digits(m), F.length(code)), F.lit(10))


def _rest_after(c: Column, n: Column) -> Column:
    return c.substr(n + 1, F.length(c))


def _luhn(digits: Column, last_doubled: bool) -> Column:
    """Luhn sum of a digit text, counting every second digit twice from the right."""
    def of(cs: Column) -> Column:
        def value(c: Column, i: Column) -> Column:
            twice = (F.size(cs) - 1 - i) % 2 == (0 if last_doubled else 1)
            return let(c.cast("int"), lambda d: F.when(twice & (d > 4), d * 2 - 9).when(twice, d * 2).otherwise(d))
        return F.aggregate(F.transform(cs, value), F.lit(0), lambda a, x: a + x)
    return let(_chars(digits), of)


def kind_of(m: Column) -> Column:
    """What a match is; null for look-alikes (bad octets, no issuer's or bad Luhn digit, plain numbers)."""
    octets = F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255)
    return (F.when(m.rlike("^" + _NAMED), F.when(_secret(m).rlike("[0-9]"), "secret"))
            .when(m.contains("@"), "email")
            .when(_is_person(m), "person")
            .when(m.rlike(r"^\d+(\.\d+){3}$"), F.when(octets, "ip"))
            .when(m.rlike(r"^[+(]") | m.rlike(r"^\d{3}[ .-]\d{3}[ .-]\d{4}$"), "phone")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"^\d(?:[ -]?\d){12,18}$"), F.when(_is_card(m), "card")))


def _is_card(m: Column) -> Column:
    return let(_digits(m), lambda d: F.length(d).between(13, 19) & d.rlike(ISSUERS) & (_luhn(d, False) % 10 == 0))


def _is_run(m: Column) -> Column:
    return m.rlike(r"^\d[0-9 -]{12,}$")


def parts_of(m: Column) -> Column:
    """The entities ``array<struct<at, text>>`` of a match: itself, or those within a run of numbers; look-alikes have none."""
    none = F.array().cast("array<struct<at:int,text:string>>")

    def part(at: Column, text: Column) -> Column:
        return F.array(F.struct(at.cast("int").alias("at"), text.alias("text")))

    def first(w: Column, p: Column, ahead: Column) -> Column:
        """The first entity that begins where the window does, or null."""
        found = lambda shape: F.regexp_extract(w, "^" + shape + r"(?!\d)", 0)
        cards = F.array(*map(found, _CARDS), F.when(p == 1, found(_FIRST)).otherwise(""))
        others = F.when(ahead == "-", F.array().cast("array<string>")).otherwise(F.array(*map(found, _OTHERS)))
        return F.get(F.concat(F.filter(cards, _is_card), F.filter(others, lambda c: c != "")), F.lit(0))

    def scan(cs: Column) -> Column:
        ahead = lambda p: F.coalesce(F.get(cs, p - 2), F.lit(""))
        starts = F.filter(F.sequence(F.lit(1), F.size(cs)),
                          lambda p: F.get(cs, p - 1).rlike("[0-9]") & ~ahead(p).rlike("[0-9]"))

        def step(acc: Column, p: Column) -> Column:
            text = let(F.array_join(F.slice(cs, p, F.lit(_WINDOW)), ""), lambda w: first(w, p, ahead(p)))
            return F.when(p <= acc["end"], acc).otherwise(let(text, lambda c: F.when(c.isNull(), acc).otherwise(
                F.struct((p + F.length(c) - 1).alias("end"), F.concat(acc["got"], part(p, c)).alias("got")))))

        return F.aggregate(starts, F.struct(F.lit(0).alias("end"), none.alias("got")), step, lambda acc: acc["got"])

    return (F.when(kind_of(m).isNotNull(), part(F.lit(1), m)).when(_is_run(m), let(_chars(m), scan)).otherwise(none))


def _is_person(m: Column) -> Column:
    return m.rlike("^" + _TITLE + _AFTER)


def _secret(m: Column) -> Column:
    return F.regexp_replace(m, "^" + _NAMED, "")


def _title(m: Column) -> Column:
    """The first title that says a gender, else the first."""
    titles = F.regexp_extract_all(F.regexp_extract(m, "^" + _TITLES + "(?=" + _AFTER + ")", 0),
                                  F.lit(_B + "(" + _TITLE.removesuffix(r"\.?") + ")" + _E), F.lit(1))
    return let(titles, lambda ts: F.coalesce(F.get(F.filter(ts, lambda t: t.isin(*MALE, *FEMALE)), F.lit(0)), F.get(ts, F.lit(0))))


def _name_part(m: Column) -> Column:
    return F.regexp_replace(m, "^" + _TITLES + _AFTER, "")


def _name_words(m: Column) -> Column:
    """The words of a person's name, initials without their dots."""
    return F.regexp_extract_all(_name_part(m), F.lit(_WORD), F.lit(0))


def _name_kind(title: Column, i: Column, n: Column) -> Column:
    """Words before the last are given names, of the gender that the title says."""
    return (F.when(i == n - 1, "family").when(title.isin(*MALE), "given0").when(title.isin(*FEMALE), "given1")
            .otherwise("given2"))


def _named(m: Column) -> Column:
    """``array<struct<kind, word>>`` of a person's name without initials, which are no units."""
    return let(_name_words(m), lambda ws: F.filter(F.transform(ws, lambda w, i: F.struct(
        _name_kind(_title(m), i, F.size(ws)).alias("kind"), w.alias("word"))), lambda x: F.length(x["word"]) > 1))


def names_in(ms: Column) -> Column:
    """The distinct words, family names first, of the persons among a text's matches."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(ms, _is_person), _named))))


def with_names(names: Column) -> Column:
    """ENTITY and, where none begins, any of the names as a word, also in capitals."""
    return F.concat(F.lit(ENTITY + "|" + _B + r"(?=\p{Lu})(?iu:"), F.array_join(F.transform(names, lambda x: x["word"]), "|"),
                    F.lit(")" + _E))


def _mentioned(m: Column, names: Column) -> Column:
    """The names that a match is, of which it means the first; none for a match of another kind."""
    return F.filter(names, lambda x: m.rlike("^" + _NAME + "$") & (F.lower(x["word"]) == F.lower(m)))


def _unit(kind, norm: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), norm.alias("norm"))


def units_of(m: Column) -> Column:
    """The units ``array<struct<kind, norm>>`` of a match; empty for look-alikes."""
    return F.flatten(F.transform(parts_of(m), lambda part: _units(part["text"])))


def _units(m: Column) -> Column:
    none = F.array().cast("array<struct<kind:string,norm:string>>")
    names = F.transform(_named(m), lambda x: _unit(x["kind"], F.lower(x["word"])))
    return let(kind_of(m), lambda kind: (
        F.when(kind == "email", F.array(_unit("local", F.lower(F.substring_index(m, "@", 1))),
                                        _unit("host", F.lower(F.substring_index(m, "@", -1)))))
        .when(kind == "person", names)
        .when(kind == "phone", F.array(_unit("phone", _national(m))))
        .when(kind.isin("card", "ssn"), F.array(_unit(kind, _digits(m))))
        .when(kind == "ip", F.array(_unit("ip", m)))
        .when(kind == "secret", F.array(_unit("secret", _secret(m))))
        .otherwise(none)))


def _value(hexes: Column, i) -> Column:
    """0..255: the byte for the i-th character."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.conv(hexes.substr(i * 2 % 126 + 1, F.lit(2)), 16, 10).cast("int")


def _like(text: Column, hexes: Column, sets=_ALPHABETS) -> Column:
    """Every letter and digit replaced by one of its kind and script."""
    def char(c: Column, i: Column) -> Column:
        def of(v: Column) -> Column:
            out = F
            for pattern, alphabet in sets:
                out = out.when(c.rlike(pattern), F.lit(alphabet).substr(v % len(alphabet) + 1, F.lit(1)))
            return out.otherwise(c)
        return let(_value(hexes, i), of)
    return F.when(text == "", text).otherwise(F.array_join(F.transform(_chars(text), char), ""))


def _longer(text: Column, attempt: Column) -> Column:
    """``text`` with its last letter or digit (or an x) repeated at its end, once for each attempt past SAME_LENGTH."""
    last = F.regexp_extract(text, r"([\p{L}\p{N}])[^\p{L}\p{N}]*$", 1)
    return F.concat(text, F.repeat(F.when(last == "", "x").otherwise(last), F.greatest(attempt - (SAME_LENGTH - 1), F.lit(0))))


def _name(script: str, ending: Column, hexes: Column, attempt: Column) -> Column:
    parts = F.array(*map(F.lit, _SYLLABLES[script].split()))
    stem = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(2) + attempt),
                                    lambda i: F.element_at(parts, _value(hexes, i) % 32 + 1)), "")
    return F.concat(stem, ending)


def _person_name(kind: Column, norm: Column, hexes: Column, attempt: Column) -> Column:
    def of(script: str) -> Column:
        end = F.element_at(F.array(*map(F.lit, _SYLLABLES[script].split())), _value(hexes, 60) % 32 + 1)
        for gender, ending in enumerate(_ENDINGS[script]):
            end = F.when(kind == f"given{gender}", F.lit(ending)).otherwise(end)
        return _name(script, end, hexes, attempt)
    return (F.when(norm.rlike(r"\p{IsCyrillic}"), of("cyrillic")).when(norm.rlike(r"\p{IsGreek}"), of("greek"))
            .otherwise(of("latin")))


def _card(norm: Column, h: Column) -> Column:
    body = F.concat(norm.substr(1, 1), _like(norm.substr(F.lit(2), F.length(norm) - 2), h))
    return let(body, lambda b: F.concat(b, ((10 - _luhn(b, True) % 10) % 10).cast("string")))


#: kind -> surrogate from (norm, hash, attempt)
SURROGATE = {
    "host": lambda n, h, a: F.concat(
        _like(_longer(F.regexp_extract(n, r"^(.*)\.[^.]+$", 1), a), h), F.lit("."), F.substring_index(n, ".", -1)),
    "local": lambda n, h, a: _like(_longer(n, a), h),
    "ip": lambda n, h, a: F.concat_ws(".", *[(_value(h, i) % 254 + 1).cast("string") for i in range(4)]),
    "phone": lambda n, h, a: F.concat((_value(h, 0) % 8 + 2).cast("string"), _like(_rest(n, 2), F.reverse(h))),
    "card": lambda n, h, a: _card(n, h),
    "ssn": lambda n, h, a: _like(n, h),
    "secret": lambda n, h, a: F.when(n.rlike("^[0-9a-f]+$"), _like(_longer(n, a), h, ((r"[0-9a-f]", "0123456789abcdef"),)))
    .when(n.rlike("^[0-9A-F]+$"), _like(_longer(n, a), h, ((r"[0-9A-F]", "0123456789ABCDEF"),))).otherwise(_like(_longer(n, a), h)),
}
NAMES = ("family", "given0", "given1", "given2")


def name_surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a word of a name, as surrogate_of."""
    return let(F.sha2(F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string")), 512),
               lambda h: _person_name(kind, norm, h, attempt))


def _initial(c: Column, family: Column, key: str) -> Column:
    """Another letter, one to one for a family name."""
    def of(h: Column) -> Column:
        out, low = F, F.lower(c)
        for pattern, alphabet in _ALPHABETS[1:2] + _ALPHABETS[3:5]:
            at = F.instr(F.lit(alphabet), low)  # 0: not in the alphabet
            moved = F.lit(alphabet).substr((at + _value(h, 0) % (len(alphabet) - 1)) % len(alphabet) + 1, F.lit(1))
            out = out.when(low.rlike(pattern) & (at > 0), moved)
        return F.upper(out.otherwise(_like(low, h)))
    return let(F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("initial"), F.lower(family)), 512), of)


def surrogate_of(kind: str, norm: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a unit at an attempt, in the unit's normal form."""
    return let(norm, lambda n: let(attempt, lambda a: let(
        F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(kind), n, a.cast("string")), 512),
        lambda h: SURROGATE[kind](n, h, a))))


def _in_format(m: Column, digits: Column) -> Column:
    """``m`` with its last digits replaced, separators and leading digits as they were."""
    def of(d: Column) -> Column:
        ahead = F.length(_digits(m)) - F.length(d)
        return F.array_join(F.transform(_chars(m), lambda c, i: let(
            F.length(_digits(m.substr(F.lit(1), i + 1))) - ahead,
            lambda at: F.when(c.rlike("[0-9]") & (at > 0), d.substr(at, F.lit(1))).otherwise(c))), "")
    return let(digits, of)


def _as_cased(original: Column, surrogate: Column) -> Column:
    return let(surrogate, lambda s: (
        F.when((original == F.upper(original)) & (original != F.lower(original)), F.upper(s))
        .when(original.rlike(r"^\p{Lu}"), F.concat(F.upper(s.substr(1, 1)), _rest(s, 2))).otherwise(s)))


def replacement(m: Column, tries: Column, key: str, names: Column) -> Column:
    """What a match becomes.

    ``tries``: by ``kind:norm`` of units not at their first attempt, 4 * attempt,
    and 1 or 2 more for given2 words that are given0 or given1 (may be null);
    ``names``: the names_in of the text.
    """
    def tried(kind: Column, norm: Column) -> Column:
        return F.coalesce(F.element_at(tries, F.concat_ws(":", kind, norm)), F.lit(0))

    def of(kind: str, norm: Column) -> Column:
        return let(norm, lambda n: surrogate_of(kind, n, F.floor(tried(F.lit(kind), n) / 4).cast("int"), key))

    def word(x: Column) -> Column:
        """The surrogate of a struct of kind and word."""
        return _as_cased(x["word"], let(F.lower(x["word"]), lambda n: let(tried(x["kind"], n), lambda t: name_surrogate(
            F.when(t % 4 == 1, "given0").when(t % 4 == 2, "given1").otherwise(x["kind"]), n, F.floor(t / 4).cast("int"), key))))

    email = let(F.split(m, "@"), lambda p: F.concat(
        _as_cased(p[0], of("local", F.lower(p[0]))), F.lit("@"), _as_cased(p[1], of("host", F.lower(p[1])))))
    mention = F.transform(F.slice(_mentioned(m, names), 1, 1), lambda x: F.struct(x["kind"], m.alias("word")))
    # a person's words, or the one of a mention
    words = F.when(_is_person(m), let(_name_words(m), lambda ws: F.transform(ws, lambda w, i: F.struct(
        _name_kind(_title(m), i, F.size(ws)).alias("kind"), w.alias("word"))))).otherwise(mention)
    new = let(words, lambda xs: F.transform(xs, lambda x: F.when(
        F.length(x["word"]) == 1, _initial(x["word"], F.element_at(xs, -1)["word"], key)).otherwise(word(x))))
    name = F.when(_is_person(m), _name_part(m)).otherwise(m)
    person = F.concat(F.regexp_extract(m, "^(" + _TITLES + _AFTER + ")", 1), F.array_join(F.zip_with(
        F.split(name, _WORD, -1), F.concat(new, F.array(F.lit(""))), lambda gap, w: F.concat(gap, w)), ""))

    def number(x: Column) -> Column:
        return let(kind_of(x), lambda kind: _in_format(x, (
            F.when(kind == "phone", of("phone", _national(x)))
            .when(kind == "card", of("card", _digits(x))).otherwise(of("ssn", _digits(x))))))

    # phones and numbers keep their length, so those of a run stay where they are
    numbers = F.aggregate(parts_of(m), m, lambda text, part: F.overlay(text, number(part["text"]), part["at"]))
    return let(kind_of(m), lambda kind: (
        F.when(kind == "email", email).when((kind == "person") | (kind.isNull() & (F.size(_mentioned(m, names)) > 0)), person)
        .when(kind.isin("phone", "card", "ssn") | _is_run(m), numbers)
        .when(kind == "ip", of("ip", m))
        .when(kind == "secret", F.concat(F.regexp_extract(m, "^" + _NAMED, 0), of("secret", _secret(m)))).otherwise(m)))


def matches_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def attempts(units: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct ``(kind, norm)`` -> kind, norm, attempt, surrogate, the surrogates distinct within a kind.

    A unit gives way (next attempt) if its surrogate is a unit of the corpus,
    or that of a unit settled before it or, in the same round, of smaller text.
    A round writes the units still unsettled only.
    """
    spark, paths = units.sparkSession, []
    settled = None
    taken = units.select("kind", F.col("norm").alias("surrogate"))
    now = units.select("kind", "norm")
    for attempt in range(ROUNDS):
        surrogate = F
        for kind in SURROGATE:
            surrogate = surrogate.when(F.col("kind") == kind, surrogate_of(kind, F.col("norm"), F.lit(attempt), key))
        surrogate = surrogate.when(F.col("kind").isin(*NAMES), name_surrogate(F.col("kind"), F.col("norm"), F.lit(attempt), key))
        now = stored(now.select("kind", "norm", F.lit(attempt).alias("attempt"), surrogate.alias("surrogate")), "surrogates")
        first = now.groupBy("kind", "surrogate").agg(F.min("norm").alias("w"), F.count(F.lit(1)).alias("n"))
        if settled is not None:
            taken = units.select("kind", F.col("norm").alias("surrogate")).unionByName(settled.select("kind", "surrogate"))
        hit = first.select("kind", "surrogate").join(taken, ["kind", "surrogate"]).distinct().withColumn("hit", F.lit(True))
        bad = (first.join(hit, ["kind", "surrogate"], "left").where("n > 1 OR hit")
               .select("kind", "surrogate", F.when(F.col("hit"), None).otherwise(F.col("w")).alias("winner"),
                       F.lit(True).alias("clash")))
        judged = now.join(bad, ["kind", "surrogate"], "left").select("kind", "norm", "attempt", "surrogate", (
            F.col("clash").isNotNull() & ~F.col("winner").eqNullSafe(F.col("norm"))).alias("move"))
        paths.append(scratch_dir(spark, "surrogates-judged"))
        judged.write.parquet(paths[-1])
        settled = spark.read.schema(judged.schema).parquet(*paths).where("NOT move").drop("move")
        now = spark.read.schema(judged.schema).parquet(paths[-1]).where("move").select("kind", "norm")
        if not now.limit(1).count():
            return settled
    raise ValueError(f"no distinct surrogates after {ROUNDS} attempts: {now.first()}")


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with the entities of ``text`` replaced and ``n_entities`` added (replacing one of that name).

    A null text stays null with 0 entities; texts without entities, and
    look-alikes within others, stay as they are byte for byte.  Rows are
    independent of each other but for the shared units, so null or repeated
    ids and repeated rows need no care.
    """
    kept = docs.drop("n_entities")
    found = kept.select(F.xxhash64("text").alias("t"), F.explode(matches_of(F.col("text"))).alias("m"))
    found = stored(found.select("t", F.explode(units_of(F.col("m"))).alias("u")).select("t", "u.kind", "u.norm").distinct(),
                   "entities")
    # given names whose title says no gender have that of another title of the corpus
    said = found.where("kind IN ('given0', 'given1')").groupBy("norm").agg(F.min("kind").alias("said"))
    units = stored(found.select("kind", "norm").distinct().join(said, "norm", "left").select(
        "kind", "norm", F.when(F.col("kind") == "given2", F.col("said")).alias("said")), "units")
    settled = attempts(units.where("said IS NULL").select("kind", "norm"), key)
    theirs = units.where("said IS NOT NULL").join(settled.withColumnRenamed("kind", "said"), ["said", "norm"]).select(
        "kind", "norm", (4 * F.col("attempt") + F.when(F.col("said") == "given0", 1).otherwise(2)).alias("attempt"))
    again = stored(settled.where("attempt > 0").select("kind", "norm", (4 * F.col("attempt")).alias("attempt"))
                   .unionByName(theirs), "surrogates-again")
    tries = stored(found.join(again, ["kind", "norm"]).groupBy("t").agg(F.map_from_entries(F.collect_list(
        F.struct(F.concat_ws(":", "kind", "norm"), "attempt"))).alias("_tries")), "surrogates-tries")
    marked = marked_texts(tries)
    hashed = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("_doc"), F.col("text").alias("_text"), F.xxhash64("text").alias("_t"))
    none = F.lit(None).cast("map<string,int>")
    clear = hashed.where(~marked("_t")).select("_doc", "_text", none.alias("_tries"))
    unsure = hashed.where(marked("_t")).join(tries, F.col("_t") == F.col("t"), "left").select("_doc", "_text", "_tries")
    return _rewritten(clear.unionByName(unsure), kept.columns, key)


def marked_texts(tries: DataFrame) -> Callable[[str], Column]:
    """A test of text hashes: true for every ``t`` of ``tries``, and for few others while its bits suffice.

    The bits are sized by the number of texts, MOST_SLOTS at most (4 MB);
    beyond that more of the other texts pass, and are joined in vain.
    """
    slots = 1 << max(15, min(MOST_SLOTS, (16 * tries.count()).bit_length()))
    slot = F.pmod(F.col("t"), F.lit(slots))
    rows = (tries.groupBy(F.floor(slot / 32768).cast("int").alias("part"))
            .agg(F.bitmap_construct_agg(slot % 32768).alias("bits")).collect())  # slots / 32768 rows of 4 KB
    bits = bytearray(slots // 8)
    for r in rows:
        bits[4096 * r.part:4096 * (r.part + 1)] = r.bits
    table_ = F.lit(bits)

    def test(c: str) -> Column:
        at = F.pmod(F.col(c), F.lit(slots))
        byte = F.conv(F.hex(F.substring(table_, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (at % 8).cast("int")) == 1

    return test


def _rewritten(wide: DataFrame, columns: list[str], key: str) -> DataFrame:
    """``(_doc, _text, _tries)`` -> the documents' columns with the new text, and n_entities."""
    wide = wide.withColumn("_m", matches_of(F.col("_text"))).withColumn("_names", names_in(F.col("_m")))
    named = F.size("_names") > 0
    wide = wide.withColumn("_m", F.when(named, F.regexp_extract_all("_text", with_names(F.col("_names")), F.lit(0)))
                           .otherwise(F.col("_m")))
    gaps = F.when(named, F.split("_text", with_names(F.col("_names")), -1)).otherwise(F.split("_text", ENTITY, -1))
    new = F.transform("_m", lambda m: replacement(m, F.col("_tries"), key, F.col("_names")))
    text = F.when(F.size("_m") > 0, F.array_join(F.zip_with(
        gaps, F.concat(new, F.array(F.lit(""))), lambda gap, s: F.concat(gap, s)), "")).otherwise(F.col("_text"))
    count = F.coalesce(F.aggregate("_m", F.lit(0), lambda n, m: n + F.size(parts_of(m)) + F.least(
        F.size(_mentioned(m, F.col("_names"))), F.lit(1))), F.lit(0)).cast("long")
    out = wide.select("_doc", text.alias("_new"), F.when(F.col("_text").isNull(), 0).otherwise(count).alias("n_entities"))
    return out.select(*[F.col("_new").alias(c) if c == "text" else F.col(f"_doc.`{c}`") for c in columns], "n_entities")


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace(table(spark, sf_dir, "documents").select("doc_id", "text"))
