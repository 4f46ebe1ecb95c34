"""Surrogates for personal data: keyed, type-consistent, distinct and the same at every mention.

Detected kinds: email, phone, IPv4, IPv6, payment card (Luhn), US social security
number, IBAN (country's length and mod 97), access keys, assigned secrets, and names after titles, with initials.
A mention has a canonical value (digits only, lower case, ...); the surrogate is
drawn from HMAC-SHA256 of key, kind, canonical value and attempt, and written
in the mention's own format.  Cards keep scheme, length and a right check digit,
IBANs their country and check, phones their country's code, hexadecimal secrets stay so; IPv6 addresses
become documentation ones; names keep gender (from the titles), script and case, word by word, so "Ms. Weber"
and "Anna Weber" agree.  Family names are made with endings that both genders have.

Coreference.  A title shows the words of a name; each capitalised repeat of such a word anywhere in the same text,
also with a genitive s or in a hyphenated word, is a mention too.  A name word is one value, wherever in a name it
stands; whether it is a given name and of which gender is settled over all texts (titles that disagree: either).
An initial becomes that of a given name of its text, or else a letter drawn by the key; letters are too few to be distinct.

Collision check.  Distinct values of a kind (name words: of a script) must get distinct surrogates, and no
surrogate may be a value that the corpus holds itself.  All distinct values
are drawn once; of values that share a surrogate the smallest keeps it, the
others draw again, several at a time, until none is left.  A format may have fewer free values than the corpus has
distinct ones (short secrets above all).  When a round of many draws finds no free value at all, the values of the formats
that are left are enumerated in Spark, those that are free are dealt out one each, and where they run out a value becomes stars: no
surrogate is ever a value that the corpus holds, and no two values share one but for the stars.  Only values past their first draw, and names that their text alone shows as another
part or gender, are kept as a table; workers make all other surrogates alone.  Texts meet that table by
digest: a broadcast if its measured size allows, a shuffle join otherwise.

Defined results: a null text stays null with no entities.  Repeated rows get the
same text.  ``n_entities`` replaces a column of that name; other columns pass through.
Where detections overlap, the earlier kind in ``KINDS`` wins.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import math
import re
import unicodedata
from bisect import bisect
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.llm import kernels as k
from docloom.llm.store import Table, extended

# Titles by gender: m, f, or x for either.
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин", "Κος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "г-жа", "госпожа", "Κα"],
    "x": ["Dr", "Prof"],
}
_GENDER = {t: g for g, names in TITLES.items() for t in names}
# Syllables that names are made of, by script, and the endings that mark gender.
SYLLABLES = {
    "latin": (["ba", "be", "da", "do", "fe", "ka", "la", "le", "li", "ma", "me", "mi", "na", "ni", "no", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "ti", "va", "vi"], {"m": ["n", "s", "r", "k"], "f": ["na", "la", "ra", "sa"], "x": ["e", "i"], "family": ["ner", "mann", "sen", "rin", "lay", "ton"]}),
    "cyrillic": (["ба", "ва", "го", "да", "ка", "ле", "ли", "ма", "ми", "на", "ни", "ра", "ро", "са", "се", "та", "ти"], {"m": ["н", "р", "с"], "f": ["на", "ля", "ра"], "x": ["и", "е"], "family": ["ко", "ук", "ич", "ых"]}),
    "greek": (["βα", "γε", "δη", "κα", "λα", "λε", "μα", "μι", "να", "νι", "ρα", "σα", "τα", "τε"], {"m": ["νος", "ρης"], "f": ["να", "ρα"], "x": ["ι"], "family": ["ντι", "λι", "ρι"]}),
}
LETTERS = {"latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", "greek": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"}
SAFE_DOMAINS = ["example.com", "example.net", "example.org"]

# Length of an IBAN by country, as its registry has them.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22,
    "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21,
    "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24,
    "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22,
    "VG": 24, "XK": 20,
}
# Country calling codes of one and of two digits; all others have three.
_CODES = re.compile("1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}")

_title = "|".join(sorted(map(re.escape, _GENDER), key=len, reverse=True))
_gap = r"[^\S\r\n]+"
# Parts after an apostrophe or hyphen have two letters at least, so a genitive 's stays outside; titles are no names.
_word = rf"(?!(?:{_title}|Jr)(?![\p{{L}}\p{{M}}]))(?=\p{{Lu}}[\p{{L}}\p{{M}}'’])\p{{Lu}}[\p{{L}}\p{{M}}]*+(?:['’-]\p{{L}}[\p{{L}}\p{{M}}]+)*+"
_WORD = regex.compile(rf"(?<![\p{{L}}\p{{M}}]){_word}")
_PIECE = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# Small words inside names; they stay as they are.
PARTICLES = ["van", "von", "der", "den", "dem", "de", "del", "della", "di", "da", "dos", "das", "du", "des", "la", "le", "zu", "zum", "zur", "vom", "af", "av", "bin", "ibn", "al", "el", "ter", "ten", "y"]
_small = rf"(?:(?:(?:{'|'.join(PARTICLES)}){_gap}){{1,3}}(?:[dl]['’])?|[dl]['’])"
_dotted = r"(?:\p{Lu}\.[ -]?)"
_INITIAL = regex.compile(r"\p{Lu}(?![\p{L}\p{M}'’])")
_BEFORE = regex.compile(rf"(?<![\p{{L}}\p{{M}}])(?:{_dotted}+|\p{{Lu}}[ ])$")
#: Kinds in order of precedence: a string of which a text must hold one, or "" for a digit; the pattern; the group that is the value.
KINDS: dict[str, tuple[tuple[str, ...], regex.Pattern, int]] = {
    "email": (("@",), regex.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w])"), 0),
    "secret": (("=", ":"), regex.compile(r"""(?i)(?<![\p{L}])(?:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key|bearer)["']?\s*[=:]\s*["']?([A-Za-z0-9+/_.~-]{8,}=*)"""), 1),
    "key": (("AKIA", "ASIA", "ghp_", "sk-"), regex.compile(r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])"), 0),
    "iban": (("",), regex.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}"), 0),
    "card": (("",), regex.compile(r"(?<![0-9A-Za-z.-])[3-6](?:[ -]?[0-9]){12,18}"), 0),
    "ssn": (("",), regex.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"), 0),
    "ip": (("",), regex.compile(r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])"), 0),
    "ip6": ((":",), regex.compile(r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*:[0-9A-Fa-f:]*:)[0-9A-Fa-f:]{2,39}(?![0-9A-Za-z:])"), 0),
    "phone": (("",), regex.compile(r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,6}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|\(?0[1-9][0-9]{1,3}\)?[ /-](?:[0-9]{3,4}[ -][0-9]{3,4}|[0-9]{5,8}))(?![0-9A-Za-z]|[.,-][0-9])"), 0),
    # Titles, with abbreviations such as "med." after them, then initials and up to three words, or initials alone.
    "name": (
        tuple(_GENDER),
        regex.compile(
            rf"(?<![\p{{L}}\p{{M}}])((?:(?:{_title})(?![\p{{L}}\p{{M}}])\.?(?:-Ing\.?)?(?:{_gap}|(?<=\.)|[^\S\r\n]*\r?\n[^\S\r\n]*)(?:\p{{Ll}}{{1,4}}\.[ ]?)*+){{1,6}}+)"
            rf"((?:{_dotted}*+[^\S\r\n]*(?:\p{{Lu}}{_gap})?{_small}?{_word}(?:{_gap}(?:{_dotted}++[^\S\r\n]*|\p{{Lu}}{_gap})?{_small}?{_word}){{0,2}}(?:{_gap}\p{{Lu}}\.)?|{_dotted}++))"
        ),
        2,
    ),
}
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


_GOES_ON = re.compile("-?[0-9A-Za-z]")


def _card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn(digits)


def _iban(plain: str) -> bool:
    return len(plain) == IBAN_LENGTH.get(plain[:2], 0) and _mod97(plain) == 1


def script(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def _canonical(word: str) -> str:
    return unicodedata.normalize("NFC", word.replace("’", "'")).lower()


def _part(seen: set[str]) -> str:
    """What a name word is, of all parts it was seen as: a given name if it ever is one; x if its genders disagree."""
    given = {g.removeprefix("given_") for g in seen if g != "family"}
    known = given - {"x"}
    return "family" if not given else f"given_{known.pop() if len(known) == 1 else 'x'}"


def _names(text: str, titled: list[regex.Match]) -> list[tuple[int, int, str, str]]:
    """Mentions of name words: those after titles, and every repeat of one of them in the text; initials beside them."""
    seen: dict[str, set[str]] = {}
    at: dict[int, tuple[int, str]] = {}
    initials: set[int] = set()
    for m in titled:
        gender = _part({f"given_{_GENDER[t]}" for t in regex.findall(_title, m.group(1)) if t in _GENDER}).removeprefix("given_")
        words = list(_WORD.finditer(text, *m.span(2)))
        letters = {i.start() for i in _INITIAL.finditer(text, *m.span(2))}
        initials |= letters
        # After a title a single word is a family name, or else the last one is; before a last initial it is a given name.
        last = len(words) - 1 if not words or max(letters, default=0) < words[-1].start() else -1
        for i, w in enumerate(words):
            # Hyphens and apostrophes stay; each part of two letters and more is a name word, so that it is one wherever it stands alone.
            pieces = [(w.start() + x.start(), w.start() + x.end()) for x in _PIECE.finditer(w.group()) if len(x.group()) > 1 and x.group()[0].isupper()]
            for a, b in pieces or [w.span()]:
                value = _canonical(text[a:b])
                at[a] = (b, value)
                seen.setdefault(value, set()).add("family" if i == last else f"given_{gender}")

    def known(start: int, end: int) -> bool:
        value = _canonical(text[start:end])
        if value not in seen and value.endswith("s"):
            value, end = value[:-1], end - 1
        if value in seen:
            at[start] = (end, value)
        return value in seen

    for m in _WORD.finditer(text) if seen else ():
        if m.start() not in at and not known(*m.span()):
            for piece in _PIECE.finditer(m.group()):
                if piece.group()[0].isupper():
                    known(m.start() + piece.start(), m.start() + piece.end())
    for start in at:
        if before := _BEFORE.search(text, max(0, start - 16), start):
            initials |= {i.start() for i in _INITIAL.finditer(text, *before.span()) if text[i.end()] in ".-" or i.start() in initials}
    out = [(a, b, f"{_part(seen[value])}:{script(text[a])}", value) for a, (b, value) in at.items()]
    return out + [(i, i + 1, f"initial:{script(text[i])}", text[i]) for i in initials]


def find(text: str) -> list[tuple[int, int, str, str]]:
    """Mentions of a text in order: start, end, kind and canonical value; name words are mentions of their own."""
    out: list[tuple[int, int, str, str]] = []
    digit = bool(_DIGIT.search(text))
    for kind, (marks, pattern, group) in KINDS.items():
        if not any(digit if m == "" else m in text for m in marks):
            continue
        if kind == "name":
            out += _names(text, list(pattern.finditer(text)))
            continue
        at = 0
        while m := pattern.search(text, at):
            a, b = m.span(group)
            value = m.group(group)
            at = max(m.end(), m.start() + 1)
            plain = re.sub(r"[^0-9A-Za-z]", "", value)
            if kind in ("card", "iban"):
                # What follows, such as a month of expiry or a word in capitals, may look like more of it: shorter ends are tried.
                good = _card if kind == "card" else _iban
                b = next((e for e in range(b, a + 12, -1) if text[e - 1].isalnum() and not _GOES_ON.match(text, e) and good(re.sub(r"[ -]", "", text[a:e]))), 0)
                at = b or a + 1
                if not b:
                    continue
                plain = re.sub(r"[ -]", "", text[a:b])
            elif kind == "phone":
                if not 8 <= len(plain) <= 15:
                    continue
                plain = "+" + plain if value[0] == "+" else plain
            elif kind == "ip6":
                try:
                    plain = ipaddress.IPv6Address(value).compressed
                except ValueError:
                    continue
                if plain in ("::", "::1"):  # nobody's address
                    continue
            elif kind == "email":
                plain = value.lower()
            elif kind in ("secret", "ip", "key"):
                plain = value
            out.append((a, b, kind, plain))
    if len(out) < 2:
        return out
    rank = {n: i for i, n in enumerate(KINDS)}
    kept: list[tuple[int, int, str, str]] = []
    for x in sorted(out, key=lambda x: (rank.get(x[2], len(rank)), x[0])):
        i = bisect(kept, x)
        if (i == 0 or kept[i - 1][1] <= x[0]) and (i == len(kept) or x[1] <= kept[i][0]):
            kept.insert(i, x)
    return kept


class _Stream:
    """Numbers drawn from HMAC-SHA256 in counter mode."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.name = key, f"{kind}\x00{attempt}\x00{value}".encode()
        self.block, self.at, self.count = b"", 0, 0

    def below(self, n: int) -> int:
        while True:
            if self.at + 2 > len(self.block):
                self.block, self.at = hmac.new(self.key, self.count.to_bytes(4, "big") + self.name, hashlib.sha256).digest(), 0
                self.count += 1
            x = int.from_bytes(self.block[self.at : self.at + 2], "big")
            self.at += 2
            if x < 65536 - 65536 % n:
                return x % n

    def like(self, value: str, hexadecimal: bool = False) -> str:
        """A string of the same digits, letters and cases."""
        out = []
        for c in value:
            if hexadecimal:
                out.append("0123456789abcdef"[self.below(16)] if c.islower() or c.isdigit() else "0123456789ABCDEF"[self.below(16)])
            elif "0" <= c <= "9":
                out.append(str(self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(26)))
            else:
                out.append(c)
        return "".join(out)


# Networks of IPv4 by their first two bytes that are private, shared, local or for groups; a surrogate stays in its own.
_NETWORKS = [((10, 10), (0, 255)), ((172, 172), (16, 31)), ((192, 192), (168, 168)), ((100, 100), (64, 127)), ((127, 127), (0, 255)), ((169, 169), (254, 254)), ((224, 239), (0, 255))]


def _ip_class(value: str) -> list[tuple[int, int]]:
    """Ranges of the four bytes of a surrogate: the value's own network, or for a public address the reserved ones, which are nobody's."""
    a, b = map(int, value.split(".")[:2])
    own = next((n for n in _NETWORKS if n[0][0] <= a <= n[0][1] and n[1][0] <= b <= n[1][1]), ((240, 254), (0, 255)))
    return [*own, (0, 255), (0, 255)]


def _phone_head(value: str) -> int:
    """How many characters of a phone number stay: plus and country code, or the zero before a national one."""
    return _CODES.match(value, 1).end() if value[0] == "+" else int(value[0] == "0")


#: Formats of more values than this are never enumerated.
_COUNTABLE = 2**40
_PLACES = {"0": "0123456789", "a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def _template(value: str) -> str:
    return re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", value)))


def format_of(kind: str, value: str) -> str:
    """What all surrogates that a value can have share, as one text; names and IPv6 addresses have no end of them."""
    if kind == "ip":
        return ".".join(f"{a}-{b}" for a, b in _ip_class(value))
    if kind == "card":
        return value[0] + _template(value[1:])
    if kind == "iban":
        return value[:2] + _template(value[4:])
    if kind == "phone":
        return value[: _phone_head(value)] + "\x00" + _template(value[_phone_head(value) + 1 :])
    if kind == "key":
        head = next(m for m in KINDS["key"][0] if value.startswith(m))
        return head + "\x00" + _template(value[len(head) :])
    if kind == "secret":
        return ("x" if _hexadecimal(value) else "") + "\x00" + _template(value)
    return _template(value.split("@")[0])


def _hexadecimal(value: str) -> bool:
    return bool((value.lower() == value or value.upper() == value) and re.fullmatch("[0-9a-fA-F]+", value))


def places(kind: str, format_: str) -> list[str | list[str]]:
    """What can stand at each place of a format's surrogates; of cards and IBANs without their check digits."""
    like = lambda t: [_PLACES.get(c, c) for c in t]
    if kind == "ip":
        return [x for i, part in enumerate(format_.split(".")) for x in (["."] if i else []) + [[str(n) for n in range(int(part.split("-")[0]), int(part.split("-")[1]) + 1)]]]
    if kind == "card":
        return [format_[0], *like(format_[1:-1])]
    if kind == "iban":
        return [format_[0], format_[1], *like(format_[2:])]
    if kind == "ssn":
        return ["9", *like(format_[1:])]
    if kind in ("phone", "key"):
        head, _, rest = format_.partition("\x00")
        return [*head, *(["23456789"] if kind == "phone" else []), *like(rest)]
    if kind == "secret":
        hexadecimal, _, rest = format_.partition("\x00")
        if hexadecimal:
            return ["0123456789ABCDEF" if "A" in rest else "0123456789abcdef"] * len(rest)
        return like(rest)
    if kind == "email":
        return [*like(format_), "@", *[_PLACES["a"]] * 5, ".", SAFE_DOMAINS]
    return []


def room_of(kind: str, format_: str) -> int:
    return math.prod(map(len, places(kind, format_))) if kind in KINDS and kind != "ip6" else 2**62


def nth(kind: str, format_: str, i: int) -> str:
    """The surrogates of a format by number."""
    out = []
    for options in reversed(places(kind, format_)):
        i, at = divmod(i, len(options))
        out.append(options[at])
    made = "".join(reversed(out))
    if kind == "card":
        return next(made + str(d) for d in range(10) if luhn(made + str(d)))
    if kind == "iban":
        return f"{made[:2]}{98 - _mod97(made[:2] + '00' + made[2:]):02d}{made[2:]}"
    return made


def masked(kind: str, value: str) -> str:
    """What stands for a value whose format is full: stars, in the same place."""
    if kind == "email":
        return f"{'*' * len(value.split('@')[0])}@masked.{SAFE_DOMAINS[0]}"
    return "*" * len(value) if kind in ("secret", "ip", "ip6") else re.sub("[0-9A-Za-z]", "*", value)


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical value that stands for another."""
    s = _Stream(key, kind, value, attempt)
    if kind == "email":
        local = s.like(value.split("@")[0])
        return f"{local}@{s.like('aaaaa')}.{SAFE_DOMAINS[s.below(len(SAFE_DOMAINS))]}"
    if kind == "card":
        body = value[0] + s.like(value[1:-1])
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "iban":
        body = s.like(value[4:])
        return f"{value[:2]}{98 - _mod97(value[:2] + '00' + body):02d}{body}"
    if kind == "ssn":
        return "9" + s.like(value[1:])
    if kind == "ip":
        return ".".join(str(low + s.below(high - low + 1)) for low, high in _ip_class(value))
    if kind == "ip6":
        low = "".join(s.like("0000", hexadecimal=True) for _ in range(6))
        return ipaddress.IPv6Address(int("20010db8" + low, 16)).compressed
    if kind == "phone":
        head = _phone_head(value)
        return value[:head] + str(2 + s.below(8)) + s.like(value[head + 1 :])
    if kind == "key":
        head = next(m for m in KINDS["key"][0] if value.startswith(m))
        return head + s.like(value[len(head) :])
    if kind == "secret":
        return s.like(value, hexadecimal=_hexadecimal(value))
    part, name = kind.split(":")
    if part == "initial":
        others = LETTERS[name].replace(value, "")
        return others[s.below(len(others))]
    syllables, ends = SYLLABLES[name]
    # More draws, longer names: room enough for any number of distinct ones.
    many = 2 + s.below(2) + attempt // 2
    return "".join(syllables[s.below(len(syllables))] for _ in range(many)) + (e := ends[part.removeprefix("given_")])[s.below(len(e))]


def render(mention: str, kind: str, stand_in: str) -> str:
    """A surrogate in the format of a mention: its separators, and its upper case."""
    if ":" in kind:
        return stand_in.upper() if len(mention) > 1 and mention.isupper() else stand_in[0].upper() + stand_in[1:]
    if kind == "email":
        local, domain = stand_in.split("@")
        made = "".join(c.upper() if m.isupper() else c for c, m in zip(local, mention.split("@")[0], strict=True))
        return f"{made}@{domain.upper() if mention.split('@')[1].isupper() else domain}"
    if kind in ("secret", "key", "ip"):
        return stand_in
    if kind == "ip6":
        return stand_in.upper() if mention.upper() == mention else stand_in
    rest = iter(stand_in.removeprefix("+"))
    return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in mention)


def _mentions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        digests = batch.column(0)
        for a, b in k.slices(batch.column(1)):
            for i, text in enumerate(batch.column(1).slice(a, b - a).to_pylist()):
                if text and (found := find(text)):
                    d = digests[a + i].as_py()
                    rows += [(d, kind, value) for kind, value in {x[2:] for x in found if not x[2].startswith("initial:")}]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=["digest", "kind", "value"])


def _draw(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [surrogate(key, *row) for row in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.string())], names=["kind", "value", "attempt", "stand_in"])

    return run


#: Draws of a value in one round, at the most.
MANY_DRAWS = 64


def _formats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = list(zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True))
        formats = [format_of(*p) if p[0] in KINDS else "" for p in pairs]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(formats, pa.string()), pa.array([min(room_of(p[0], f), 2**62) for p, f in zip(pairs, formats, strict=True)], pa.int64())], names=["kind", "value", "format", "size"])


#: Values of a format that one row of the enumeration stands for.
_BLOCK = 65_536


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for kind, format_, size, block in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
            for a in range(block * _BLOCK, min(size, (block + 1) * _BLOCK), 4_096):
                made = [nth(kind, format_, i) for i in range(a, min(size, (block + 1) * _BLOCK, a + 4_096))]
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(made)), pa.array([format_] * len(made)), pa.array(made)], names=["kind", "format", "stand_in"])


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [masked(*p) for p in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, pa.string())], names=["kind", "value", "stand_in"])


def _numbered(rows: DataFrame, order: Column) -> DataFrame:
    """``number`` within kind and format, by a distributed sort: place in the whole less the format's first place."""
    whole = rows.orderBy("kind", "format", order).rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    placed = Table(rows.sparkSession.createDataFrame(whole, T.StructType([*rows.schema.fields, T.StructField("place", T.LongType())])), "placed").df
    first = placed.groupBy("kind", "format").agg(F.min("place").alias("first"))
    return placed.join(first, ["kind", "format"]).withColumn("number", F.col("place") - F.col("first")).drop("place", "first")


def _counted_out(open_: DataFrame, taken: DataFrame, key: bytes, attempt: int) -> DataFrame:
    """``kind, value, attempt, stand_in`` of values whose draws are exhausted: the free values of their formats, one each, and
    stars for what is left when those have run out.  Formats too large to enumerate keep drawing."""
    room = F.substring_index("kind", ":", -1).alias("room")
    wanted = Table(open_.select("kind", "value").mapInArrow(_formats, "kind string, value string, format string, size long").filter(F.col("size") <= _COUNTABLE), "wanted").df
    formats = wanted.select("kind", "format", "size").distinct()
    blocks = formats.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("size") - 1) / _BLOCK).cast("long"))))
    every = blocks.repartition("kind", "format", "block").mapInArrow(_spelled, "kind string, format string, stand_in string")
    free = every.groupBy(room, "stand_in").agg(F.min(F.struct("kind", "format")).alias("of")).join(taken, ["room", "stand_in"], "left_anti").select("of.kind", "of.format", "stand_in")
    seed = int.from_bytes(hmac.new(key, b"order", hashlib.sha256).digest()[:7], "big")
    given = _numbered(free, F.xxhash64(F.lit(seed), "stand_in"))
    asked = _numbered(wanted.select("kind", "format", "value"), F.xxhash64(F.lit(seed), "value"))
    matched = Table(asked.join(given, ["kind", "format", "number"], "left").select("kind", "value", "stand_in"), "matched").df
    rest = matched.filter("stand_in is null").mapInArrow(_masked, "kind string, value string, stand_in string")
    return matched.filter("stand_in is not null").union(rest).select("kind", "value", F.lit(attempt).alias("attempt"), "stand_in")


def settle(entities: DataFrame, key: bytes) -> Table:
    """``kind``, ``value``, ``attempt`` and ``stand_in`` of distinct entities, without collisions in a kind, or among the names of a script."""
    schema = "kind string, value string, attempt int, stand_in string"
    room = F.substring_index("kind", ":", -1).alias("room")
    own = Table(entities.select("kind", "value"), "entities")
    open_, done = Table(own.df, "open"), None
    attempt, many = 0, 1
    while True:
        tries = open_.df.withColumn("attempt", F.explode(F.sequence(F.lit(attempt), F.lit(attempt + many - 1))))
        drawn = Table(tries.mapInArrow(_draw(key), schema), "drawn")
        # Values of the corpus and settled surrogates are taken; of the rest the smallest value wins a surrogate.
        # Cards and the like keep parts of their value, so a value may draw itself: that is taken too.
        taken = own.df.select(room, F.col("value").alias("stand_in"))
        if done is not None:
            taken = taken.union(done.df.select(room, "stand_in"))
        first = drawn.df.groupBy(room, "stand_in").agg(F.min(F.struct("value", "kind", "attempt")).alias("least"))
        free = first.join(taken, ["room", "stand_in"], "left_anti").select("least.kind", "least.value", F.struct("least.attempt", "stand_in").alias("got"))
        won = Table(free.groupBy("kind", "value").agg(F.min("got").alias("got")).select("kind", "value", "got.attempt", "got.stand_in"), "won")
        lost = Table(open_.df.join(won.df, ["kind", "value"], "left_anti"), "open")
        if many == MANY_DRAWS and won.df.isEmpty():
            # Draws find no free value any more, so the formats are all but full: their free values are counted out instead.
            won.drop()
            won = Table(_counted_out(open_.df, taken, key, attempt + many), "won")
            lost.drop()
            lost = Table(open_.df.join(won.df, ["kind", "value"], "left_anti"), "open")
        over = lost.df.isEmpty()
        if done is None:
            done = won
        else:
            new = Table(done.df.unionByName(won.df), "settled")
            done.drop()
            won.drop()
            done = new
        drawn.drop()
        open_.drop()
        open_ = lost
        if over:
            open_.drop()
            own.drop()
            return done
        attempt, many = attempt + many, min(MANY_DRAWS, 2 * many)


def _rewrite(key: bytes, text_at: int, later_at: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in k.slices(batch.column(text_at)):
                here = batch.slice(a, b - a)
                texts, counts = [], []
                for text, later in zip(here.column(text_at).to_pylist(), here.column(later_at).to_pylist(), strict=True):
                    found = find(text) if text else []
                    if found:
                        known = {(x["kind"], x["value"]): x["stand_in"] for x in later or ()}
                        parts, at = [], 0
                        made = {x[2:]: known.get(x[2:]) or surrogate(key, *x[2:]) for x in found}
                        given = {(kind.split(":")[1], value[0].upper()): made[kind, value] for kind, value in sorted(made, reverse=True) if kind.startswith("given_")}
                        for x, y, kind, value in found:
                            stand_in = made[kind, value]
                            if kind.startswith("initial:"):
                                stand_in = given.get((kind.split(":")[1], value), stand_in)[0]
                            parts += [text[at:x], render(text[x:y], kind, stand_in)]
                            at = y
                        text = "".join([*parts, text[at:]])
                    texts.append(text)
                    counts.append(len(found))
                cols = [pa.array(texts, pa.string()) if i == text_at else here.column(i) for i in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(counts, pa.int64())], names=names)

    return run


def replace_private(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text_col``, and ``n_entities``, the number of mentions replaced.

    The key is the caller's secret: who has it, or can guess it, can try out values of short formats.  An empty one is refused.
    """
    if not key:
        raise ValueError("surrogates need a key")
    digest = F.unhex(F.sha2(F.col(text_col).cast("binary"), 256))
    mentions = Table(docs.select(digest.alias("digest"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull()).mapInArrow(_mentions, "digest binary, kind string, value string"), "mentions")
    found = mentions.df.select("kind", "value").distinct()
    # One part and gender for a name word, of all that the texts show; ``_part`` as columns.
    part, name = F.substring_index("kind", ":", 1), F.substring_index("kind", ":", -1)
    male, female, given = (F.max(part.isin(*parts)) for parts in (["given_m"], ["given_f"], ["given_m", "given_f", "given_x"]))
    one = F.when(~given, "family").when(male & ~female, "given_m").when(female & ~male, "given_f").otherwise("given_x")
    is_name = F.contains("kind", F.lit(":"))
    settled_names = found.filter(is_name).groupBy(name.alias("script"), "value").agg(one.alias("part"), F.collect_set("kind").alias("kinds"))
    names = Table(settled_names.select(F.explode("kinds").alias("kind"), "value", F.concat_ws(":", "part", "script").alias("as_kind")), "names")
    settled = settle(found.filter(~is_name).union(names.df.select(F.col("as_kind").alias("kind"), "value").distinct()), key)
    drawn_again = settled.df.filter("attempt > 0").filter(~is_name).select("kind", "value", "stand_in")
    named = settled.df.withColumnRenamed("kind", "as_kind").join(names.df, ["as_kind", "value"]).filter("attempt > 0 or kind <> as_kind").select("kind", "value", "stand_in")
    later = Table(drawn_again.union(named), "again")
    by_text = mentions.df.distinct().join(later.side(), ["kind", "value"]).groupBy("digest").agg(F.collect_list(F.struct("kind", "value", "stand_in")).alias("__docloom_later"))
    by_text = Table(by_text, "later")
    for table in (mentions, names, settled, later):
        table.drop()
    keep = [c for c in docs.columns if c != "n_entities"]
    left = docs.select(*[F.col(f"`{c}`") for c in keep], digest.alias("__docloom_digest"))
    joined = left.join(by_text.side().withColumnRenamed("digest", "__docloom_digest"), "__docloom_digest", "left").select(*[F.col(f"`{c}`") for c in keep], "__docloom_later")
    schema = extended(docs, keep, n_entities=T.LongType())
    return joined.mapInArrow(_rewrite(key, keep.index(text_col), len(keep), list(range(len(keep))), [*keep, "n_entities"]), schema)
