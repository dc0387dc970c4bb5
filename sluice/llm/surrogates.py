"""Personal data replaced by keyed surrogates (operator 2).

Found entities (mail addresses, phone numbers, IP addresses, payment cards, social
security numbers, IBANs, secrets, personal names) get a replacement of the same type
and format: lengths, separators, letter case and script stay, card and IBAN check
digits stay right or wrong as they were, country codes stay, and given names keep
their gender.

A surrogate is a keyed permutation of all values of its format, made of one single
cycle, so that by construction

* the same entity has the same surrogate in every document (coreference),
* two entities never share one (distinctness), and none is its own surrogate.

Where not every value of a format is allowed (check digits, listed given names,
address ranges), the cycle is followed to the next allowed value, which keeps all
three.  ``colliding_surrogates`` checks distinctness over a whole corpus.  No table of
entities is needed: documents are replaced where they are, without a shuffle.

A name is found after a title or as a listed given name with a capitalised name after
it; the family name is then replaced wherever the same document has it.

Results for edge cases: null and empty texts stay; texts without entities stay byte
for byte; repeated rows get equal texts; an empty table stays empty; ``replace_private``
returns exactly the columns it got, whatever their names.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sluice.llm.common import arrow_map, id_field, Memo, staged

TYPES = ("email", "phone", "ipv4", "card", "ssn", "iban", "secret", "person", "ipv6")

# ------------------------------------------------------------------ permutations


def hash_key(key: bytes) -> bytes:
    """The key as the hash takes it: of more than 64 bytes, their digest."""
    return key if len(key) <= 64 else hashlib.blake2b(key).digest()


class Cycle:
    """A keyed permutation of 0..n-1 that is one cycle: it never maps a value to itself."""

    def __init__(self, key: bytes, tweak: str, n: int):
        self.n = n
        self.a = max(1, int(n**0.5) if n < 1 << 52 else 1 << (n.bit_length() // 2))
        self.b = -(-n // self.a)
        self.key = hashlib.blake2b(f"{tweak}|{n}".encode(), key=hash_key(key), digest_size=32).digest()

    def _round(self, i: int, value: int, modulus: int) -> int:
        data = i.to_bytes(1, "big") + value.to_bytes((value.bit_length() + 7) // 8 or 1, "big")
        size = (modulus.bit_length() + 7) // 8 + 8
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=min(64, size)).digest(), "big") % modulus

    def _forth(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(0, 8, 2):
            left = (left + self._round(i, right, self.a)) % self.a
            right = (right + self._round(i + 1, left, self.b)) % self.b
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(6, -1, -2):
            right = (right - self._round(i + 1, left, self.b)) % self.b
            left = (left - self._round(i, right, self.a)) % self.a
        return left * self.b + right

    def next(self, x: int) -> int:
        """The value after ``x`` on the cycle."""
        if self.n < 2:
            return x
        y = self._back(x)
        while y >= self.n:
            y = self._back(y)
        y = self._forth((y + 1) % self.n)
        while y >= self.n:
            y = self._forth(y)
        return y


def next_allowed(cycle: Cycle, x: int, allowed: Callable[[int], bool]) -> int:
    """The next allowed value after an allowed ``x``; ``x`` itself only if it is the only one."""
    y = cycle.next(x)
    while y != x and not allowed(y):
        y = cycle.next(y)
    return y


# ------------------------------------------------------------------ letters
DIGITS = "0123456789"
HEX = DIGITS + "abcdef"
VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnpqrstvwxyz"
# Letters that replace one another; lower case, upper case follows the original.
ALPHABETS = (
    DIGITS, VOWELS, CONSONANTS,
    "áéíóúàèìòùâêîôûäëïöü", "ñçšžčćřłń",
    "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ",
    "åæøãõāēīōūąęėįųőűœý", "ðþşğťďňľĺŕżźśķļņģșțħ", "ёіїєў", "ґђјљњћџ", "άέήίόύώ",
)
# Scripts without case: whole ranges of code points.
RANGES = ((0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0x3041, 0x3094), (0x30A1, 0x30F4), (0x05D0, 0x05EA), (0x0621, 0x063A), (0x0641, 0x064A))
_PLACE = {c: (a, i) for a in ALPHABETS for i, c in enumerate(a)}


def _slot(c: str, alphabet: str | None) -> tuple[int, int, Callable[[int], str]] | None:
    """(size, position, letter of a position) of a lower-case character that may change."""
    if alphabet is not None:
        return (len(alphabet), alphabet.index(c), alphabet.__getitem__) if c in alphabet else None
    if c in _PLACE:
        letters, i = _PLACE[c]
        return len(letters), i, letters.__getitem__
    for lo, hi in RANGES:
        if lo <= ord(c) <= hi:
            return hi - lo + 1, ord(c) - lo, lambda k, lo=lo: chr(lo + k)
    return None


@cache
def _cycle(key: bytes, tweak: str, n: int) -> Cycle:
    return Cycle(key, tweak, n)


def permuted(
    key: bytes, tweak: str, value: str, alphabet: str | None = None, allowed: Callable[[str], bool] | None = None
) -> str:
    """A lower-case value with its letters and digits replaced within their kind."""
    slots = [_slot(c, alphabet) for c in value]
    n, x = 1, 0
    for s in slots:
        if s:
            x, n = x * s[0] + s[1], n * s[0]
    shape = "".join("." if s is None else chr(0xE000 + min(s[0], 6000)) for s in slots)

    def spell(y: int) -> str:
        out = []
        for c, s in zip(reversed(value), reversed(slots)):
            if s:
                y, i = divmod(y, s[0])
                c = s[2](i)
            out.append(c)
        return "".join(reversed(out))

    cycle = _cycle(key, f"{tweak}|{shape}", n)
    if allowed is None:
        return spell(cycle.next(x))
    return spell(next_allowed(cycle, x, lambda y: allowed(spell(y))))


def like_case(value: str, model: str) -> str:
    return "".join(v.upper() if m.isupper() else v for v, m in zip(value, model))


def fold(value: str) -> str:
    """Lower case letter by letter, of the same length."""
    return "".join(low if len(low := c.lower()) == 1 else c for c in value)


def digits_of(value: str) -> str:
    """The digits of any script, as ASCII digits."""
    return "".join(str(int(c)) for c in value if c.isdecimal())


def with_digits(model: str, digits: str) -> str:
    """``model`` with other digits of the same scripts."""
    it = iter(digits)
    return "".join(chr(ord(c) - int(c) + int(next(it))) if c.isdecimal() else c for c in model)


def luhn_digit(digits: str) -> int:
    """The check digit that belongs after ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


# ------------------------------------------------------------------ names
# Given names by script and gender (fixed values).
GIVEN = {
    ("latin", "m"): "Adam Albert Alexander Andrew Anthony Antonio Arthur Benjamin Bernard Brian Carlos Charles Christian Daniel "
    "David Diego Dietrich Edward Emil Eric Ernst Fernando Franz Friedrich George Guillaume Hans Henri Henry Hugo Jacques James Javier "
    "Jean Johann John Jorge José Joseph Juan Jules Julien Karl Kevin Klaus Kurt Lars Laurent Louis Lucas Luis Manuel Marcel Mark Martin "
    "Matthew Michael Miguel Nicolas Oliver Oscar Otto Pablo Patrick Paul Pedro Peter Philippe Pierre Rafael Raymond Richard Robert "
    "Roger Samuel Sebastian Simon Stefan Stephen Thomas Victor Walter Werner William Wolfgang Xavier",
    ("latin", "f"): "Adele Alice Amanda Amélie Ana Andrea Angela Anna Anne Barbara Beatriz Brigitte Camille Carla Carmen Caroline "
    "Catherine Cecilia Charlotte Chloé Christine Clara Claire Cristina Diana Dorothy Elena Elisabeth Elizabeth Ella Emily Emma Erika "
    "Eva Florence Frieda Gabriela Greta Hannah Heidi Helen Helga Ingrid Irene Isabel Jane Jennifer Jessica Johanna Julia Julie Karen "
    "Katharina Laura Linda Lisa Lucía Luisa Margaret Maria María Marie Martha Mary Mathilde Monika Nadine Nancy Nicole Nora Olivia "
    "Patricia Paula Petra Rachel Rebecca Rosa Ruth Sabine Sandra Sarah Silvia Simone Sofía Sophie Susan Teresa Ursula Valérie Vera",
    ("cyrillic", "m"): "Александр Алексей Андрей Антон Борис Виктор Владимир Дмитрий Иван Игорь Михаил Николай Олег Павел Сергей",
    ("cyrillic", "f"): "Александра Анна Вера Галина Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана София Татьяна Юлия",
    ("greek", "m"): "Αλέξανδρος Ανδρέας Γιώργος Δημήτρης Κώστας Μιχάλης Νίκος Παύλος Πέτρος Σπύρος",
    ("greek", "f"): "Άννα Βασιλική Γεωργία Ειρήνη Ελένη Κατερίνα Μαρία Σοφία Χριστίνα Ζωή",
}
_GIVEN = {k: v.split() for k, v in GIVEN.items()}
_KIND_OF = {name.lower(): (kind, i) for kind, names in _GIVEN.items() for i, name in enumerate(names)}

TITLES = {
    "m": "Mr Mister Sir Herr Señor Sr Don Monsieur".split(),
    "f": "Mrs Ms Miss Madam Frau Señora Sra Señorita Srta Doña Madame Mme Mademoiselle Mlle".split(),
    "": "Dr Doctor Prof Professor".split(),
}
_UPPER = "A-ZÀ-ÖØ-ÞŠŽČŁА-ЯΆΈ-ΏΑ-Ω"
_NAME = rf"[{_UPPER}][^\W\d_]+(?:[-'’][^\W\d_]+)?"
_PAIR = re.compile(rf"(?<!\w)({_NAME})\.? (?=[{_UPPER}])")  # where a title or a given name may stand
_TITLED = re.compile(rf"({_NAME})\.? ({_NAME})(?: ({_NAME}))?(?: ({_NAME}))?")
_LISTED = re.compile(rf"({_NAME}) ({_NAME})")
_TITLE_GENDER = {t: g for g, ts in TITLES.items() for t in ts}


def _titlecase(word: str) -> bool:
    return word[:1].isupper() and not word.isupper()


# ------------------------------------------------------------------ finders
_EMAIL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+\-]*[A-Za-z0-9_%+\-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IPV4 = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])(?!\.\d)")
_NUMBERS = re.compile(r"(?<![\d.+])\d+(?:[ \-]\d+)*")
_GROUP = re.compile(r"\d+")
_CARD_GROUPS = frozenset(((4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4), (4, 5, 6), (4, 3, 3, 3)))
_CARD_WORD = re.compile(
    r"(?i)(?<![^\W\d_])(?:(?:credit|debit|kredit)?(?:card|karte)|carte|tarjeta|карт[аыу]|visa|master ?card|amex|american express|maestro|diners"
    r"|discover|jcb|unionpay|cc)(?![^\W\d_])[^\d\n]{0,16}\Z"
)
# (first, last, digits): issuer prefixes of ISO/IEC 7812 in use and the lengths of their cards
_ISSUERS = [
    ("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)),
    ("300", "305", (14, 16, 17, 18, 19)), ("3095", "3095", (14, 16, 17, 18, 19)), ("36", "36", (14, 16, 17, 18, 19)),
    ("38", "39", (14, 16, 17, 18, 19)), ("3528", "3589", (16, 17, 18, 19)), ("50", "50", range(13, 20)), ("56", "58", range(13, 20)),
    ("6", "6", range(13, 20)), ("2200", "2204", (16, 17, 18, 19)), ("81", "82", (16, 17, 18, 19)), ("9792", "9792", (16,)),
    ("8600", "8600", (16,)), ("9860", "9860", (16,)), ("1", "1", (15,)),
]
_SSN = re.compile(r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])")
_GAP = r"[\s|!#%$&*]{1,8}"
_PHONE = re.compile(
    rf"(?<![\d+])\+\d{{1,3}}(?:{_GAP})?\(\d{{2,4}}\)(?:{_GAP})?\d{{3,4}}[ .\-]?\d{{3,4}}(?!\d)"
    r"|(?<![\d+])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?!\d)"
    rf"|(?<![\d+])\(\d{{3}}\)(?:{_GAP})?\d{{3}}[ .\-]\d{{4}}(?!\d)"
    r"|(?<![\d.\-+])(?:1[.\-])?\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])"
)
_IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SMALL_IBAN = re.compile(r"(?<![A-Za-z0-9])[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?(?![A-Za-z0-9])")
_PASSWORD = re.compile(r"(?i)\b(?:password|passwd|pwd)[\"']?\s*[:=]\s*[\"']?([^\s\"',;<>]{6,})")
_HEX = re.compile(r"(?<![0-9A-Za-z])(?=[0-9a-fA-F]*[0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])")
_ASSIGNED = re.compile(
    r"(?i)\b(?:token|secret|api[_\-]?key|password|passwd|pwd|access[_\-]?key|secret[_\-]?key|private[_\-]?key|auth)"
    r"[\"']?\s*[:=]\s*[\"']?([A-Za-z0-9_\-+/.]{6,}=*)"
)
_KEY_FORM = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_\-]{20,}|xox[abprs]-[A-Za-z0-9\-]{10,}"
    r"|eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,})(?![A-Za-z0-9])"
)
_KEEP_START = re.compile(r"AKIA|gh[pousr]_|sk-|xox[abprs]-|eyJ")
_DIGIT = re.compile(r"\d")


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, gender or empty) in order, without overlaps; where finders
    overlap, the one named first wins."""
    spans: list[tuple[int, int, str, str]] = []

    def take(kind: str, start: int, end: int, note: str = "") -> None:
        spans.append((start, end, kind, note))

    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        while start < at and text[start] in "._%+-":
            start += 1
        # what follows the start does not depend on it: one try at the run's first letter
        m = _EMAIL.match(text, start) if start < at else None
        if m:
            take("email", *m.span())
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    if "=" in text or ":" in text:
        for m in _PASSWORD.finditer(text):
            value = m[1].rstrip(".:)]}")
            if len(value) >= 6 and any(c in DIGITS for c in value):
                take("secret", m.start(1), m.start(1) + len(value))
        for m in _ASSIGNED.finditer(text):
            if any(c in DIGITS for c in m[1]) or "pass" in m[0].lower() or "pwd" in m[0].lower():
                take("secret", *m.span(1))
    if _DIGIT.search(text):
        for m in _KEY_FORM.finditer(text):
            take("secret", *m.span())
        for m in _HEX.finditer(text):
            take("secret", *m.span())
        for pattern, least in ((_IBAN, 0), (_SMALL_IBAN, 10)):
            for m in pattern.finditer(text):
                plain = m[0].replace(" ", "").upper()
                if iban_check(plain[:2], plain[4:]) == int(plain[2:4]) and sum(c in DIGITS for c in plain) >= least:
                    take("iban", *m.span())
        for m in _IPV6.finditer(text) if ":" in text else ():
            if _is_ipv6(m[0]):
                take("ipv6", *m.span())
        for kind, pattern in (("ipv4", _IPV4), ("ssn", _SSN), ("phone", _PHONE)):
            for m in pattern.finditer(text):
                take(kind, *m.span())
        for start, end in _find_cards(text):
            take("card", start, end)
    spans += _find_names(text)
    taken: list[tuple[int, int, str, str]] = []
    for s in spans:
        at = bisect_left(taken, s[:2])
        if (at == 0 or taken[at - 1][1] <= s[0]) and (at == len(taken) or taken[at][0] >= s[1]):
            taken.insert(at, s)
    return taken


def _is_ipv6(value: str) -> bool:
    """A whole address; with a gap, one of three groups or more and a digit, as shorter
    ones are words of programs ("Ab::Cd") or no one's address ("::1")."""
    try:
        ipaddress.IPv6Address(value)
    except ValueError:
        return False
    return "::" not in value or (sum(map(bool, value.split(":"))) >= 3 and any(c in DIGITS for c in value))


def issued(digits: str) -> bool:
    """Whether a card of this prefix and length is issued."""
    return any(len(digits) in sizes and lo <= digits[: len(lo)] <= hi for lo, hi, sizes in _ISSUERS)


def _find_cards(text: str) -> Iterator[tuple[int, int]]:
    """Numbers of an issuer's prefix and length with a right check digit.  With a wrong
    one, a number that stands alone in a card's grouping, joined by hyphens or after a
    word for a card."""
    for run in _NUMBERS.finditer(text):
        if run.end() - run.start() < 13:
            continue
        groups = [m.span() for m in _GROUP.finditer(text, *run.span())]
        found, i = [], 0
        while i < len(groups):
            for j in range(min(len(groups), i + 5), i, -1):
                start, end = groups[i][0], groups[j - 1][1]
                digits = digits_of(text[start:end]) if 13 <= end - start <= 23 else ""
                if not digits or not issued(digits):
                    continue
                alone = j - i == len(groups)
                usual = j - i == 1 or tuple(b - a for a, b in groups[i:j]) in _CARD_GROUPS
                if luhn_digit(digits[:-1]) == int(digits[-1]):
                    take = usual or alone
                else:
                    take = alone and usual and j - i > 1 and (" " not in text[start:end] or _CARD_WORD.search(text, max(0, start - 40), start))
                if take:
                    found.append((i, j))
                    i = j - 1
                    break
            i += 1
        # a long row of four-digit numbers is a table, unless all of it is cards
        if len(groups) > 6 and all(b - a == 4 for a, b in groups) and 4 * len(found) != len(groups):
            continue
        yield from ((groups[i][0], groups[j - 1][1]) for i, j in found)


def _find_names(text: str) -> list[tuple[int, int, str, str]]:
    out: list[tuple[int, int, str, str]] = []
    family: set[str] = set()
    given: dict[str, str] = {}
    for pair in _PAIR.finditer(text):
        word, start = pair[1], pair.start()
        if word in _TITLE_GENDER and (m := _TITLED.match(text, start)):
            parts = [g for g in (2, 3, 4) if m[g] and _titlecase(m[g])]
            for g in parts:
                listed = _KIND_OF.get(m[g].lower())
                if listed and (g != parts[-1] or len(parts) == 1):
                    given[m[g]] = _TITLE_GENDER[word] or listed[0][1]
                    out.append((*m.span(g), "person", "g" + given[m[g]]))
                else:
                    family.add(m[g])
                    out.append((*m.span(g), "person", "f"))
        elif _titlecase(word) and word.lower() in _KIND_OF and (m := _LISTED.match(text, start)) and _titlecase(m[2]):
            given.setdefault(word, _KIND_OF[word.lower()][0][1])
            out.append((*m.span(1), "person", "g" + given[word]))
            out.append((*m.span(2), "person", "f"))
            family.add(m[2])
    for names, note in ((family, None), (given, "g")):
        if names:
            again = re.compile(rf"\b(?:{'|'.join(re.escape(n) for n in sorted(names, key=len, reverse=True))})\b")
            out += [(*m.span(), "person", "f" if note is None else "g" + given[m[0]]) for m in again.finditer(text)]
    return list(dict.fromkeys(out))


# ------------------------------------------------------------------ surrogates
def _email(key: bytes, value: str) -> str:
    local, domain = fold(value).rsplit("@", 1)
    labels = domain.split(".")
    hosts = [permuted(key, "host", label) for label in labels[:-1]]
    return like_case(permuted(key, "local", local) + "@" + ".".join([*hosts, labels[-1]]), value)


# Country calling codes (E.164) by length: 1 and 7 are whole, these have two digits, all others three.
_CODES_2 = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def phone_parts(value: str) -> tuple[str, str]:
    """(country code with its plus sign or empty, national digits), however the number is spaced."""
    digits = digits_of(value)
    if not value.startswith("+"):
        return ("+1", digits[1:]) if len(digits) == 11 and digits[0] == "1" else ("", digits)
    n = 1 if digits[0] in "017" else 2 if digits[:2] in _CODES_2 else 3
    return "+" + digits[:n], digits[n:]


def _phone(key: bytes, value: str) -> str:
    code, national = phone_parts(value)
    return with_digits(value, code[1:] + permuted(key, "phone", national))


_PRIVATE = (("10.0.0.0", 24), ("172.16.0.0", 20), ("192.168.0.0", 16), ("127.0.0.0", 24), ("169.254.0.0", 16))


def _ipv4(key: bytes, value: str) -> str:
    x = int(ipaddress.IPv4Address(".".join(str(int(p)) for p in value.split("."))))
    for base, bits in _PRIVATE:
        b = int(ipaddress.IPv4Address(base))
        if x >> bits == b >> bits:
            return str(ipaddress.IPv4Address(b + _cycle(key, f"ip{base}", 1 << bits).next(x - b)))

    def public(y: int) -> bool:
        return not any(y >> bits == int(ipaddress.IPv4Address(base)) >> bits for base, bits in _PRIVATE)

    return str(ipaddress.IPv4Address(next_allowed(_cycle(key, "ip", 1 << 32), x, public)))


def _scope(first: int) -> tuple[int, int]:
    """The least and largest first group of the addresses of one kind: public, local to a
    site, a link or many receivers, and others."""
    for lo, hi in ((0x2000, 0x3FFF), (0xFC00, 0xFDFF), (0xFE80, 0xFEBF), (0xFF00, 0xFFFF)):
        if lo <= first <= hi:
            return lo, hi
    return 1, 0xFFFF


def _ipv6(key: bytes, value: str) -> str:
    """Groups of zero stay, the others change and stay others, so every spelling of an
    address keeps its form."""
    groups = [int(g, 16) for g in ipaddress.IPv6Address(value).exploded.split(":")]
    used = [i for i, g in enumerate(groups) if g]
    spans = [_scope(groups[0]) if i == 0 else (1, 0xFFFF) for i in used]
    n, x = 1, 0
    for i, (lo, hi) in zip(used, spans):
        n, x = n * (hi - lo + 1), x * (hi - lo + 1) + groups[i] - lo
    cycle = _cycle(key, "ipv6|" + "".join("x" if g else "0" for g in groups) + (f"|{spans[0][0]}" if groups[0] else ""), n)

    def spell(y: int) -> list[int]:
        out = [0] * 8
        for i, (lo, hi) in zip(reversed(used), reversed(spans)):
            y, r = divmod(y, hi - lo + 1)
            out[i] = lo + r
        return out

    # an address of no special kind stays one
    other = bool(groups[0]) and spans[0] == (1, 0xFFFF)
    new = spell(next_allowed(cycle, x, lambda y: _scope(spell(y)[0]) == (1, 0xFFFF)) if other else cycle.next(x))
    pieces = value.split(":")
    # groups before the gap count from the left, those after it from the right
    gap = value.split("::")[0].count(":") + 1 if "::" in value and not value.startswith("::") else 0 if "::" in value else len(pieces)
    upper = value.isupper()
    out = []
    for i, piece in enumerate(pieces):
        if piece:
            g = new[i] if i < gap else new[8 - len(pieces) + i]
            word = f"{g:0{len(piece)}x}" if piece[0] == "0" or not int(piece, 16) else f"{g:x}"
            out.append(word.upper() if upper else word)
        else:
            out.append("")
    return ":".join(out)


def _card(key: bytes, value: str) -> str:
    digits = digits_of(value)
    off = (int(digits[-1]) - luhn_digit(digits[:-1])) % 10
    body = digits[0] + permuted(key, "card" + digits[0], digits[1:-1])
    return with_digits(value, body + str((luhn_digit(body) + off) % 10))


def _ssn(key: bytes, value: str) -> str:
    return with_digits(value, permuted(key, "ssn", digits_of(value)))


def _iban(key: bytes, value: str) -> str:
    plain = value.replace(" ", "").upper()
    rest = permuted(key, "iban" + plain[:2], plain[4:].lower()).upper()
    new = plain[:2] + f"{iban_check(plain[:2], rest):02d}" + rest
    it = iter(new.lower() if value.islower() else new)
    return "".join(" " if c == " " else next(it) for c in value)


def _secret(key: bytes, value: str) -> str:
    low = fold(value)
    if re.fullmatch(r"[0-9a-f]{16,}", low):
        return like_case(permuted(key, "hex", low, HEX), "".join("A" if value.isupper() else "a" for _ in value))
    m = _KEEP_START.match(value)
    head = m[0] if m else ""
    # upper and lower case are different here, so they are permuted apart
    tail = value[len(head) :]
    lower = permuted(key, "secret|" + "".join("u" if c.isupper() else "l" for c in tail), fold(tail))
    return head + like_case(lower, tail)


def _person(key: bytes, value: str) -> str:
    """One permutation for a name, whether it stands as given or as family name: listed
    names become listed ones of their script and gender, others become others."""
    low = fold(value)
    listed = _KIND_OF.get(low)
    if listed is None:
        return like_case(permuted(key, "family", low, None, lambda x: x not in _KIND_OF), value)
    names = _GIVEN[listed[0]]
    new = names[_cycle(key, "given" + "".join(listed[0]), len(names)).next(listed[1])]
    return new.upper() if value.isupper() else new


_MAKE = {
    "email": _email, "phone": _phone, "ipv4": _ipv4, "card": _card, "ssn": _ssn, "iban": _iban, "secret": _secret, "person": _person,
    "ipv6": _ipv6,
}


def surrogate(key: bytes, kind: str, value: str, note: str = "") -> str:
    """The replacement of one entity; it depends on ``canonical(kind, value)`` but for
    format, not on the entity's ``note``."""
    return _MAKE[kind](key, value)


def canonical(kind: str, value: str) -> str:
    """What makes two spellings the same entity."""
    if kind == "phone":
        return "|".join(phone_parts(value))
    if kind in ("card", "ssn"):
        return digits_of(value)
    if kind == "iban":
        return value.replace(" ", "").upper()
    if kind == "ipv6":
        return ipaddress.IPv6Address(value).exploded
    if kind == "ipv4":
        return ".".join(str(int(p)) for p in value.split("."))
    if kind == "secret" and not re.fullmatch(r"[0-9a-fA-F]{16,}", value):
        return value
    return fold(value)


class Replacer:
    """Replaces the entities of texts under one key, remembering recent surrogates."""

    def __init__(self, key: bytes):
        self.memo = Memo(lambda k: surrogate(key, *k), 50_000)

    def entities(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, type, surrogate)."""
        return [(a, b, kind, self.memo[kind, text[a:b], note]) for a, b, kind, note in find_entities(text)]

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str, str]]]:
        found = self.entities(text)
        out, at = [], 0
        for a, b, _, new in found:
            out += [text[at:a], new]
            at = b
        return "".join([*out, text[at:]]) if found else text, found


@cache
def replacer(key: bytes) -> Replacer:
    """One per worker process."""
    return Replacer(key)


def replace_private(docs: DataFrame, key: bytes, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with surrogates in ``text_col``; ``chars_col``, if the table has it, gets
    the new length of changed texts."""
    has_chars = chars_col in docs.columns if chars_col else False

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = replacer(key)
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            chars = batch.column(chars_col).to_pylist() if has_chars else []
            for i, text in enumerate(texts):
                if text:
                    texts[i], found = r.replace(text)
                    if found and has_chars:
                        chars[i] = len(texts[i])
            columns = [
                pa.array(texts, f.type) if f.name == text_col
                else pa.array(chars, f.type) if has_chars and f.name == chars_col
                else batch.column(f.name)
                for f in batch.schema
            ]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.transform(arrow_map, run, docs.schema)


def private_counts(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, the replaced ``text``, ``n_entities`` and ``n_<type>`` for every row."""
    counts = [f"n_{t}" for t in TYPES]
    schema = StructType([
        id_field(docs, id_col), StructField("text", StringType()),
        *(StructField(c, LongType()) for c in ("n_entities", *counts)),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = replacer(key)
        for batch in batches:
            got = [r.replace(t) if t else (t, []) for t in batch.column("text").to_pylist()]
            columns = [batch.column("id"), pa.array([g[0] for g in got], pa.string())]
            columns.append(pa.array([len(g[1]) for g in got], pa.int64()))
            for t in TYPES:
                columns.append(pa.array([sum(e[2] == t for e in g[1]) for g in got], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(arrow_map, run, schema)


def entity_fingerprints(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """(kind, original, surrogate) of every entity as keyed digests: no value in clear."""

    def mark(kind: str, value: str) -> bytes:
        return hashlib.blake2b(f"{kind}|{canonical(kind, value)}".encode(), key=hash_key(key), digest_size=16).digest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = replacer(key)
        for batch in batches:
            rows = {
                (kind, mark(kind, t[a:b]), mark(kind, new))
                for t in batch.column("text").to_pylist() if t for a, b, kind, new in r.entities(t)
            }
            kinds, old, new = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(old, pa.binary()), pa.array(new, pa.binary())],
                names=["kind", "original", "surrogate"],
            )

    return docs.select(F.col(text_col).alias("text")).transform(arrow_map, run, "kind string, original binary, surrogate binary")


def colliding_surrogates(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """The collision check: surrogates of more than one entity and entities with more
    than one surrogate, over the whole corpus; no rows if all is well."""
    found = staged(docs.sparkSession, entity_fingerprints(docs, key, text_col).distinct(), "surrogate-marks")
    shared = found.groupBy("kind", "surrogate").agg(F.min("original").alias("lo"), F.max("original").alias("hi"))
    split = found.groupBy("kind", "original").agg(F.min("surrogate").alias("lo"), F.max("surrogate").alias("hi"))
    return (
        shared.where("lo != hi").select("kind", F.lit("shared").alias("fault"), F.col("surrogate").alias("mark"))
        .unionByName(split.where("lo != hi").select("kind", F.lit("split").alias("fault"), F.col("original").alias("mark")))
    )


def require_distinct(docs: DataFrame, key: bytes, text_col: str = "text") -> None:
    """Raises where ``colliding_surrogates`` finds any."""
    faults = colliding_surrogates(docs, key, text_col).limit(5).collect()
    if faults:
        raise ValueError(f"surrogates collide: {faults}")
