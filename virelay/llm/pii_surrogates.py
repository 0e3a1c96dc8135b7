"""Personal data replaced by keyed surrogates of the same kind and form.

Entities are detected by patterns and reduced to a normal form, so that mentions
in different forms are one entity; names found once in a text are found wherever
they stand in it.  A keyed hash draws each entity's surrogate: digits for digits,
letters for letters of the same script and case, valid check digits for valid
ones, names of the gender that the mentions tell, addresses and numbers from
ranges that belong to nobody where there are such.  A table of all entities is
then checked: of entities with one surrogate the first keeps it, and none gets a
surrogate that is some entity's real value or has been given already; the others
draw again, from ranges that widen without end.  Each entity thus has one
surrogate everywhere (coreference), and no two have the same.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, discard, slices, stored

#: Draws after which ranges widen, again and again.
WIDEN = 8

# Titles by gender.
TITLES = {
    "m": ("Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н", "κύριος"),
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Doña", "госпожа", "г-жа", "κυρία"),
    "u": ("Dr", "Prof", "Professor", "доктор"),
}
# Common given names by gender.
GIVEN = {
    "m": (
        "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Steven Paul Andrew Joshua Kevin Brian George Edward"
        " Timothy Jason Ryan Jacob Nicholas Eric Jonathan Stephen Justin Benjamin Samuel Alexander Patrick Henry Peter Liam Noah Oliver Ethan Lucas"
        " Hans Klaus Jürgen Stefan Andreas Pierre Jean Jacques Luc Carlos José Juan Pedro Miguel Javier Giovanni Marco Иван Пётр Сергей Алексей Дмитрий Γιώργος Νίκος"
    ).split(),
    "f": (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Margaret Sandra Ashley Emily Michelle Amanda Melissa Deborah Stephanie Rebecca"
        " Laura Helen Sharon Cynthia Kathleen Angela Ruth Nicole Samantha Christine Catherine Rachel Emma Olivia Sophia Isabella Charlotte Amelia Julia Hannah"
        " Anna Maria Petra Ursula Sabine Monika Marie Claire Sophie Camille Carmen Lucía Elena Rosa Giulia Анна Мария Ольга Наталья Екатерина Ελένη Σοφία"
    ).split(),
}
# Letters and endings that surrogate names are made of, by script.
SYLLABLES = {
    "latin": ("b d f g k l m n p r s t v".split(), "a e i o u".split(), {"f": ("a", "ia", "ine"), "m": ("on", "er", "us"), "u": ("en", "is", "y")}),
    "cyrillic": ("б в г д к л м н п р с т".split(), "а е и о у".split(), {"f": ("а", "ия", "ина"), "m": ("ан", "ор", "ей"), "u": ("ен", "ис", "о")}),
    "greek": ("β γ δ κ λ μ ν π ρ τ".split(), "α ε ι ο".split(), {"f": ("α", "ια", "ινα"), "m": ("ος", "ης", "ων"), "u": ("ι", "ις", "ο")}),
}
# Months, and what streets are called.
MONTHS = "January February March April May June July August September October November December".split()
STREETS = "Street St Avenue Ave Road Rd Lane Ln Drive Boulevard Blvd Court Square Terrace"
RUES = "rue avenue boulevard place chemin calle avenida plaza via piazza"

_title = "|".join(sorted((re.escape(t) for ts in TITLES.values() for t in ts), key=len, reverse=True))
_upper = "A-Z\u00c0-\u00d6\u00d8-\u00de\u0160\u017d\u0391-\u03ab\u0410-\u042f\u0401"
_name = rf"(?!(?:{_title})\b)[{_upper}](?:[^\W\d_]|['’-](?=[^\W\d_]))*"
_names_of = rf"(?:{_name}\s+|[{_upper}]\.\s*){{0,2}}{_name}"
_month = "|".join(MONTHS)
_date = rf"\d{{4}}-\d{{1,2}}-\d{{1,2}}|\d{{1,2}}[./-]\d{{1,2}}[./-]\d{{4}}|\d{{1,2}}(?:st|nd|rd|th)? (?:{_month}),? \d{{4}}|(?:{_month}) \d{{1,2}}(?:st|nd|rd|th)?,? \d{{4}}"
_octet = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_streets, _rues = STREETS.replace(" ", "|"), RUES.replace(" ", "|")
# Each kind's pattern, with what a text must have for it to be tried; group 1, where there is one, is what is replaced.
PATTERNS = (
    ("email", "@", re.compile(r"[\w.+%-]*\w@(?:[\w-]+\.)+[^\W\d_]{2,}")),
    ("secret", "", re.compile(r"""(?i:\b(?:[\w-]*(?:token|secret|passw(?:or)?d|passwd|pwd|credential)|api[_-]?key|access[_-]?key|private[_-]?key|auth))["']?\s*(?:=|:)\s*(?:bearer\s+)?["']?((?=[^\s"']*\d)[^\s"'<>,;]{6,})""")),
    ("secret", "ass", re.compile(r"""(?i:\b(?:password|passwd|passcode|passphrase))\s+(?:is|was)\s*:?\s+["']?((?=[^\s"']*\d)[^\s"'<>,;]{5,}[^\s"'<>,;.])""")),
    ("secret", "", re.compile(r"\b((?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{20,}|eyJ[\w-]{10,}\.[\w-]{10,}\.[\w-]*|(?=[0-9a-f]*[a-f])(?=[a-f]*\d)[0-9a-f]{32,}|(?=[0-9A-F]*[A-F])(?=[A-F]*\d)[0-9A-F]{32,})\b")),
    ("iban", "", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("ipv4", ".", re.compile(rf"(?<![\w.])(?:{_octet}\.){{3}}{_octet}(?![\w]|\.\d)")),
    ("ipv6", ":", re.compile(rf"(?<![\w:.])(?:[0-9A-Fa-f]{{0,4}}:){{2,7}}(?:(?:\d+\.){{3}}\d+|[0-9A-Fa-f]{{1,4}}|(?<=::))(?![\w:])")),
    ("passport", "assport", re.compile(r"(?i:\bpassport)(?:\s+(?i:no|nr|number|id))?\.?\s*(?:is|:|=|#)?\s*((?=(?:[A-Z]*\d){3})[A-Z0-9]{6,9})\b")),
    ("birth", "", re.compile(rf"(?i:\b(?:born|dob|d\.o\.b\.|date of birth|birth ?date|birthday))(?:\s+(?:on|is|was))?\s*:?\s*({_date})\b")),
    ("ssn", "-", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("card", "", re.compile(r"(?<![\w-])(?:\d{4}[ -]){3}\d{1,7}(?![\w-])|(?<![\w-])3\d{3}[ -]\d{6}[ -]\d{5}(?![\w-])|(?<![\w-])\d{13,19}(?![\w-])")),
    ("phone", "", re.compile(
        r"(?<![\d+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}(?!\d)"
        r"|(?<![\w.+-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-])"
        r"|(?<![\w.+-])(?<!\d )\d{3} \d{3} \d{4}(?![\w-]| ?\d)|(?<![\w.+-])(?<!\d )0\d(?:[ .-]\d{2}){4}(?![\w-]| ?\d)|(?<![\w.+-])(?<!\d )0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}(?![\w-]| ?\d)"
    )),
    ("address", "", re.compile(
        rf"(?<![\w.,-])\d{{1,5}} (?:[{_upper}][^\W\d_]+ ){{1,3}}(?:{_streets})\b|(?<!\w)[{_upper}][^\W\d_]+(?:straße|strasse|weg|platz|allee|gasse) \d{{1,4}}[a-z]?(?!\w)"
        rf"|(?<![\w.,-])\d{{1,4}},? (?:{_rues}) (?:d[eu] (?:la |los )?|des |del |d['’])?[{_upper}][^\W\d_]+"
    )),
)
NAMES = (
    re.compile(rf"\b(?P<title>{_title})\b\.?\s+(?P<names>{_names_of})"),
    re.compile(rf"(?:\b[Mm]y name is|\b[Nn]ame:|\b[Ss]igned(?: by)?:?|\b[Rr]egards,|\bSincerely,)\s+(?P<names>{_names_of})|\bDear (?P<dear>{_names_of})(?=,)"),
    re.compile(rf"(?P<names>(?:{_name}\s+){{1,2}}{_name})\s*<[^<>\s@]+@"),
)
LISTED = {n: g for g, ns in GIVEN.items() for n in ns}
GIVEN_NAME = re.compile(rf"\b({_name})\s+(?:[{_upper}]\.\s*)?({_name})")
WORD = re.compile(rf"\b[{_upper}](?:[^\W\d_]|['’-](?=[^\W\d_]))*")
TITLE_WORDS = frozenset(t for ts in TITLES.values() for t in ts)
OTHER_TITLES = tuple(t for t in TITLE_WORDS if not t[0].isupper())
CUES = ("y name is", "ame:", "igned", "egards,", "Sincerely,", "Dear ", "<")
DIGIT = re.compile(r"\d")


@dataclass(frozen=True)
class Mention:
    """A place in a text, its entity's kind and normal form, and the gender that it tells (m, f, or u: none)."""

    start: int
    end: int
    kind: str
    normal: str
    gender: str = "u"


def script_of(word: str) -> str:
    cp = ord(word[0])
    return "cyrillic" if 0x400 <= cp < 0x530 else "greek" if 0x370 <= cp < 0x400 or 0x1F00 <= cp < 0x2000 else "latin"


def normal_form(kind: str, text: str) -> str:
    """Mentions with one normal form are one entity: case doesn't count, nor do separators of numbers and the form of an address."""
    if kind == "phone":
        return "+" * text.startswith("+") + re.sub(r"\D", "", text)
    if kind in ("card", "ssn", "iban"):
        return re.sub(r"[^0-9A-Za-z]", "", text).lower()
    if kind == "ipv6":
        return ipaddress.IPv6Address(text).exploded
    if kind == "secret" and not re.fullmatch(r"[0-9a-fA-F]+", text):
        return text
    return " ".join(text.lower().split())


def plausible(kind: str, text: str) -> bool:
    """What a pattern can't tell of its match."""
    digits = sum(c.isdigit() for c in text)
    if kind == "phone":
        return 7 <= digits <= 15
    if kind == "card":
        return 13 <= digits <= 19 and text[0] in "23456" and luhn(re.sub(r"\D", "", text))
    if kind == "ipv6":
        try:
            return digits > 0 and ipaddress.IPv6Address(text) > ipaddress.IPv6Address("::ffff")
        except ValueError:
            return False
    return True


def surname(word: str) -> tuple[str, str]:
    """Kind and normal form of a family name; Slavic ones are one name in both genders."""
    script = script_of(word)
    if script == "cyrillic" and re.search("(?:ов|ев|ёв|ин|ын)а?$", word) and len(word) > 4:
        return "surname-cyrillic", word.removesuffix("а")
    return f"name-{script}", word


def named(text: str) -> list[Mention]:
    """Names behind titles, cues and listed given names, and all other mentions of their words in the text."""
    words = set(WORD.findall(text))
    titled = not words.isdisjoint(TITLE_WORDS) or any(t in text for t in OTHER_TITLES)
    found: list[tuple[str, str, int]] = []  # names, gender, start
    if titled:
        for m in NAMES[0].finditer(text):
            found.append((m["names"], next(g for g, ts in TITLES.items() if m["title"] in ts), m.start("names")))
    if any(c in text for c in CUES):
        for m in NAMES[1].finditer(text):
            group = "names" if m["names"] else "dear"
            found.append((m[group], "u", m.start(group)))
        if "@" in text and "<" in text:
            found += [(m["names"], "u", m.start("names")) for m in NAMES[2].finditer(text)]
    if not words.isdisjoint(LISTED):
        at = 0
        while m := GIVEN_NAME.search(text, at):
            at = m.end(1)
            if m[1] in LISTED:
                found.append((m[0], LISTED[m[1]], m.start()))
                at = m.end()
    if not found:
        return []
    known: dict[str, tuple[str, str]] = {}
    genders: dict[int, str] = {}
    for names, gender, start in found:
        parts = [w for w in re.finditer(_name, names) if len(w[0]) > 1]
        for k, w in enumerate(parts):
            word = w[0].lower()
            if k == len(parts) - 1:
                known.setdefault(word, surname(word))
            else:
                known[word] = f"name-{script_of(word)}", word
                genders[start + w.start()] = gender if gender != "u" else LISTED.get(w[0], "u")
    by_normal = {normal: kind for kind, normal in known.values()}
    out = []
    for w in WORD.finditer(text):
        word = w[0].lower()
        kind, normal = known.get(word) or surname(word)
        if by_normal.get(normal) == kind and (len(word) > 1):
            out.append(Mention(w.start(), w.end(), kind, normal, genders.get(w.start(), "u")))
    return out


def detect(text: str) -> list[Mention]:
    """Entities in order, without overlaps; of two that overlap the one of the earlier kind stays."""
    out: list[Mention] = []
    starts: list[int] = []

    def add(m: Mention) -> None:
        k = bisect.bisect_left(starts, m.start)
        if (k == 0 or out[k - 1].end <= m.start) and (k == len(out) or m.end <= starts[k]):
            starts.insert(k, m.start)
            out.insert(k, m)

    hinted = "@" in text or DIGIT.search(text) is not None
    for kind, needed, pattern in PATTERNS if hinted else ():
        if needed in text:
            for m in pattern.finditer(text):
                a, b = m.span(1) if m.lastindex else m.span()
                if plausible(kind, text[a:b]):
                    add(Mention(a, b, kind, normal_form(kind, text[a:b])))
    for m in named(text):
        add(m)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


class Draw:
    """A stream of keyed choices for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, normal: str, attempt: int):
        self._seed = hmac.new(key, f"{kind}\0{normal}\0{attempt}".encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        self._count, self._pool = 0, 0

    def below(self, n: int) -> int:
        if self._pool < n << 16:
            self._pool = int.from_bytes(hashlib.sha256(self._seed + self._count.to_bytes(4, "little")).digest(), "little")
            self._count += 1
        self._pool, out = divmod(self._pool, n)
        return out

    def char(self, c: str, hexadecimal: bool = False) -> str:
        """A character of the same class, script and case; others stay."""
        if hexadecimal:
            d = "0123456789abcdef"[self.below(16)]
            return d.upper() if c.isupper() else d
        if c.isdigit():
            return str(self.below(10))
        if c.isalpha():
            script = script_of(c)
            letters = "abcdefghijklmnopqrstuvwxyz" if script == "latin" else "".join(SYLLABLES[script][0] + SYLLABLES[script][1])
            d = letters[self.below(len(letters))]
            return d.upper() if c.isupper() else d
        return c


def _digits(draw: Draw, n: int) -> str:
    return "".join(str(draw.below(10)) for _ in range(n))


def _date_like(draw: Draw, normal: str, wide: int) -> str:
    """A date of the same form: years are years, other numbers may be days or months, whatever their order."""

    def number(m: re.Match) -> str:
        if len(m[0]) == 4:
            return str(1930 + draw.below(75) if not wide else 1000 + draw.below(9000))
        return str(1 + draw.below(12)).zfill(len(m[0]))

    out = re.sub(r"\d+", number, normal)
    return re.sub(_month.lower(), lambda m: MONTHS[draw.below(12)].lower(), out)


def _ipv4(draw: Draw, normal: str, wide: int) -> str:
    """Private addresses stay in their range, others move to one that is reserved and never routed."""
    octets = [int(x) for x in normal.split(".")]
    fixed = [octets[0]] if octets[0] in (10, 127) else octets[:2] if octets[:2] == [192, 168] else [172, 16 + draw.below(16)] if octets[0] == 172 and 16 <= octets[1] < 32 else [240 + draw.below(15)]
    if wide > 1:
        fixed = [240 + draw.below(15)]
    rest = []
    for o in normal.split(".")[len(fixed) :]:
        low, high = (0, 255) if wide else {1: (1, 9), 2: (10, 99), 3: (100, 254)}[len(o)]
        rest.append(low + draw.below(high - low + 1))
    return ".".join(map(str, [*fixed, *rest]))


def _email(key: bytes, draw: Draw, normal: str) -> str:
    """Another local part, at a domain that stands for the real one everywhere, below one that nobody can register."""
    local, _, domain = normal.rpartition("@")
    labels = domain.split(".")
    other = Draw(key, "domain", domain, 0)
    common = labels[-1] in ("com", "org", "net")
    own = labels[: -2 if common and len(labels) > 2 else -1]
    return "".join(draw.char(c) for c in local) + "@" + ".".join(["".join(other.char(c) for c in x) for x in own] + (["example", labels[-1]] if common else ["example"]))


def _word(draw: Draw, script: str, gender: str, syllables: int) -> str:
    consonants, vowels, endings = SYLLABLES[script]
    body = "".join(consonants[draw.below(len(consonants))] + vowels[draw.below(len(vowels))] for _ in range(syllables))
    return body + consonants[draw.below(len(consonants))] + endings[gender][draw.below(len(endings[gender]))]


def surrogate(key: bytes, kind: str, normal: str, attempt: int, gender: str = "u") -> str:
    """The normal form that stands for an entity at its ``attempt``-th draw; later draws come from wider ranges, at last with more characters."""
    draw, wide = Draw(key, kind, normal, attempt), attempt // WIDEN
    more = max(0, wide - 2)  # characters beyond the form
    if kind.startswith("name-"):
        return _word(draw, kind.removeprefix("name-"), gender, 1 + draw.below(2) + wide)
    if kind == "surname-cyrillic":
        consonants, vowels, _ = SYLLABLES["cyrillic"]
        body = "".join(consonants[draw.below(len(consonants))] + vowels[draw.below(len(vowels))] for _ in range(1 + draw.below(2) + wide))
        return body + consonants[draw.below(len(consonants))] + normal[-2:]
    if kind == "address":
        out = re.sub(r"\d", lambda m: str(1 + draw.below(9)), normal) if wide < 2 else re.sub(r"\d+", lambda m: str(1 + draw.below(10**5)), normal)
        kept = {*STREETS.lower().split(), *RUES.split(), "de", "du", "la", "des", "del", "los"}
        end = re.compile("(?:straße|strasse|weg|platz|allee|gasse)$")
        new = [w if w in kept or not w[0].isalpha() or len(w) == 1 else _word(draw, "latin", "u", 1 + wide) + (end.search(w) or [""])[0] for w in out.split(" ")]
        return " ".join(new)
    if kind == "email":
        name = _email(key, draw, normal)
        return "".join(draw.char("a") for _ in range(wide)) + name
    if kind == "ipv4":
        return _ipv4(draw, normal, wide) if wide < 3 else ".".join(["240", *(str(draw.below(256 * 10 ** (wide - 3))) for _ in range(3))])
    if kind == "ipv6":
        groups = normal.split(":")
        keep = groups[:1] if groups[0][:2] in ("fd", "fc", "fe") else ["2001", "0db8"]
        rest = [g if g == "0000" and not wide else "".join(draw.char("0", True) for _ in range(4)) for g in groups[len(keep) :]]
        if set(rest) == {"0000"}:
            rest[-1] = "".join(draw.char("0", True) for _ in range(4))
        return ":".join(keep + rest)
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+", normal):
        return "".join(draw.char(c, True) for c in normal + "0" * more)
    if kind == "card":
        out = normal[0] + _digits(draw, len(normal) - 1 + more)
        return next(out[:-1] + d for d in "0123456789" if luhn(out[:-1] + d))
    if kind == "phone":
        plus, digits = normal[: normal.startswith("+")], normal.removeprefix("+")
        if len(digits) == 10 and not plus and digits[0] != "0" or len(digits) == 11 and digits[0] == "1":  # numbers kept free for fiction
            line = "01" + _digits(draw, 2) if not wide else _digits(draw, 4)
            exchange = "555" if wide < 2 else str(2 + draw.below(8)) + _digits(draw, 2)
            return plus + digits[:-10] + str(2 + draw.below(8)) + _digits(draw, 2) + exchange + line + _digits(draw, more)
        keep = 2 if plus or digits[0] == "0" else 0
        return plus + digits[:keep] + str(2 + draw.below(8)) + _digits(draw, len(digits) - keep - 1 + more)
    if kind == "ssn":  # never issued with a first digit of 9
        return "9" + _digits(draw, 8 + more)
    if kind == "iban":
        out = normal[:2] + "00" + "".join(draw.char(c) for c in normal[4:]) + _digits(draw, more)
        return out[:2] + f"{98 - _mod97(out):02d}" + out[4:] if _mod97(normal) == 1 else out[:2] + "".join(draw.char(c) for c in normal[2:]) + _digits(draw, more)
    if kind == "birth":
        return _date_like(draw, normal, wide) + _digits(draw, more)
    return "".join(draw.char(c) for c in normal) + "".join(draw.char(normal[-1]) for _ in range(more))


def rendered(mention: str, kind: str, normal: str) -> str:
    """A surrogate's normal form in a mention's form: its separators and case."""
    if kind.startswith(("name-", "surname-")):
        if kind == "surname-cyrillic" and mention.lower().endswith("а"):
            normal += "а"
        return normal.upper() if mention.isupper() and len(mention) > 1 else normal[0].upper() + normal[1:]
    if kind == "address":
        return normal.upper() if mention.isupper() else " ".join(w if a.islower() else w[0].upper() + w[1:] for a, w in zip(mention.split(), normal.split(" "), strict=True))
    if kind in ("ipv4", "ipv6"):
        out = normal if kind == "ipv4" or len(mention) == len(normal) else str(ipaddress.IPv6Address(normal))
        return out.upper() if kind == "ipv6" and any(c in "ABCDEF" for c in mention) else out
    if kind == "birth":
        return normal.title() if any(c.isupper() for c in mention) else normal
    if len(normal) == len(mention):
        return "".join(b.upper() if a.isupper() else b for a, b in zip(mention, normal, strict=True))
    if kind == "email":
        return normal.upper() if mention.isupper() else normal
    if kind in ("secret", "passport"):
        return normal.upper() if mention.isupper() else normal
    rest = iter(normal.removeprefix("+"))
    form = "".join((x.upper() if c.isupper() else x) if c.isalnum() and c.isascii() and (x := next(rest, "")) else c for c in mention)
    return form + "".join(rest)


ENTITIES = "kind string, normal string, gender string, attempt int, surrogate string"


def assigned(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, normal, surrogate of all entities; surrogates are distinct and no entity's real value, over all kinds.

    An entity's gender is that of the mentions that tell one, if they agree.
    Draws are checked as a table, round by round: those that are real, or were
    given in an earlier round, or are drawn by an entity before (by kind and
    normal form), draw again.  Only a round's own draws travel; the outcome
    depends on the entities and the key alone.
    """

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("kind", "normal", "gender", "attempt")), strict=True))
            found = [surrogate(key, k, n, a, g) for k, n, g, a in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], ["kind", "normal", "gender", "attempt", "surrogate"])

    told = F.collect_set(F.when(F.col("gender") != "u", F.col("gender")))
    pending = stored(entities.groupBy("kind", "normal").agg(F.when(F.size(told) == 1, told[0]).otherwise("u").alias("gender")), "pii-entities")
    real = F.when(F.col("kind") == "surname-cyrillic", F.array("normal", F.concat("normal", F.lit("а")))).otherwise(F.array("normal"))
    taken = pending.select(F.explode(real).alias("surrogate"))
    todo, rounds = pending.withColumn("attempt", F.lit(0)), []
    while True:
        new = stored(todo.select("kind", "normal", "gender", "attempt").mapInArrow(drawn, ENTITIES), "pii-draws")
        first = new.groupBy("surrogate").agg(F.min(F.struct("kind", "normal")).alias("first"))
        gone = taken.join(new.select("surrogate"), "surrogate", "left_semi").distinct().withColumn("gone", F.lit(True))
        judged = new.join(first, "surrogate").join(gone, "surrogate", "left")
        good = (F.struct("kind", "normal") == F.col("first")) & F.col("gone").isNull()
        judged = stored(judged.select("kind", "normal", "gender", "attempt", "surrogate", good.alias("good")), "pii-judged")
        discard(new)
        rounds.append(judged)
        kept, lost = judged.filter("good"), judged.filter("not good")
        if lost.isEmpty():
            break
        taken = taken.unionByName(kept.select("surrogate"))
        todo = lost.withColumn("attempt", F.col("attempt") + 1)
    every = rounds[0].filter("good")
    for judged in rounds[1:]:
        every = every.unionByName(judged.filter("good"))
    out = stored(every.select("kind", "normal", "surrogate"), "pii-surrogates")
    discard(pending, *rounds)
    return out


MENTIONS = "array<struct<start:int,end:int,kind:string,normal:string,gender:string>>"
MENTION = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("normal", pa.string()), ("gender", pa.string())]))


def with_surrogates(df: DataFrame, key: bytes, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (default: all), with the text's entities replaced, and ``n_replaced``.

    Every row gives a row.  Null stays null and texts without entities stay as
    they are, in one narrow pass; only the others are dealt out again, to meet
    their entities' surrogates.  Equal entities get equal surrogates in all rows,
    repeated rows included.  A column of ``df`` named ``n_replaced`` is replaced.
    Empty tables give no row.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c not in ("n_replaced", text_col)]
    # Inside, columns have numbers, so that no name can clash.
    sent = df.select(*[column(c).alias(f"c{k}") for k, c in enumerate(keep)], column(text_col).cast("string").alias("text"))
    own = sent.columns
    struct = T.StructType([*sent.schema.fields, T.StructField("mentions", T._parse_datatype_string(MENTIONS))])
    done_schema = T.StructType([*sent.schema.fields, T.StructField("n_replaced", T.LongType())])

    def split(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text", 2 << 20):
                found = [detect(t) if t else [] for t in batch.column(batch.num_columns - 1).to_pylist()]
                rows = batch.filter(pa.array([bool(f) == wanted for f in found], pa.bool_()))
                if wanted:
                    mentions = [[{"start": m.start, "end": m.end, "kind": m.kind, "normal": m.normal, "gender": m.gender} for m in f] for f in found if f]
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(mentions, MENTION)], [*own, "mentions"])
                else:
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([0] * rows.num_rows, pa.int64())], [*own, "n_replaced"])

        return run

    clean = sent.mapInArrow(split(False), done_schema)
    # Numbered once and written, so that a row's entities find it again.
    private = stored(sent.mapInArrow(split(True), struct).withColumn("row", F.monotonically_increasing_id()), "pii-mentions")
    mentions = private.select("row", F.explode("mentions").alias("m")).select("row", "m.kind", "m.normal", "m.gender").distinct()
    table = assigned(mentions, key)
    pairs = mentions.select("row", "kind", "normal").distinct().join(table, ["kind", "normal"]).groupBy("row").agg(F.collect_list(F.struct("kind", "normal", "surrogate")).alias("pairs"))

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts, counts = [], []
            for text, places, known in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", "mentions", "pairs")), strict=True):
                known = {(p["kind"], p["normal"]): p["surrogate"] for p in known}
                parts, at = [], 0
                for m in places:
                    parts += [text[at : m["start"]], rendered(text[m["start"] : m["end"]], m["kind"], known[m["kind"], m["normal"]])]
                    at = m["end"]
                texts.append("".join([*parts, text[at:]]))
                counts.append(len(places))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own[:-1]), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], [*own, "n_replaced"])

    done = private.join(pairs, "row").select(*own, "mentions", "pairs").mapInArrow(replaced, done_schema)
    every = clean.unionByName(done)
    names = {f"c{k}": c for k, c in enumerate(keep)} | {"text": text_col}
    order = [c for c in df.columns if c in (*keep, text_col)] if not (set(keep) - set(df.columns)) else [*keep, text_col]
    back = {v: k for k, v in names.items()}
    return every.select(*[F.col(back[c]).alias(c) for c in order], "n_replaced")
