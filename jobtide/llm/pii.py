"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Entities: e-mail addresses, phone numbers, payment cards, IBANs, IPv4 and IPv6 addresses, US social security numbers, secrets
assigned to a key, and names of persons (after a form of address, or known first names with a surname).

A surrogate is a keyed bijection on the values of one kind and shape (which letters, digits and signs stand where):
the value is a number in the mixed radix of its shape, moved by q^-1(q(x) + s) for a keyed Feistel permutation q and a keyed
shift s. So equal entities get equal surrogates in every document and on every executor without any shared table
(coreference), different ones get different ones (distinctness), and none stays as it is where its shape has a
second value. Known first names move inside their list of one gender and script, all others among the
names that are in no list, so the two never meet. Vowels become vowels and consonants consonants of the same alphabet; letters without a
table move among the letters of their kind in their block of Unicode; case, accents' places, grouping, country codes and forms of address
stay; card numbers that pass the Luhn check and IBANs keep valid check digits. What has nothing to move, or a letter that is alone,
becomes a keyed code, so nothing stays in clear text.

Collision checks: every task checks what it replaces; should two entities ever meet in one surrogate, the later one
takes its keyed code instead. `surrogate_collisions` checks a whole corpus, its result is empty.

Null text stays null, empty text stays empty, texts without entities pass unchanged; repeated rows are rows
of their own; whole texts are searched, whatever their length, in time linear in it; columns of other names are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, record_batch

# Forms of address by gender, and known first names by gender and script.
ADDRESS = {
    "f": "Mrs Ms Frau Mme Mlle Madame Mademoiselle Sra Srta Señora Señorita Signora г-жа".split(),
    "m": "Mr Herr Monsieur Sr Señor Signor г-н".split(),
    "": "Dr Prof".split(),
}
FIRST_NAMES = {
    ("f", "latin"): "Anna Maria Sofia Laura Julia Emma Clara Elena Marie Sarah Alice Olivia Hannah Lucia Carmen Isabel Camille Chloé Manon Greta Ingrid Katharina Emily Grace Martha Nora".split(),
    ("m", "latin"): "Peter Thomas Michael David Daniel Martin Paul Lukas Felix Jonas Hans Karl Pierre Jean Louis Antoine Pedro Pablo Carlos Miguel José Luis James John Robert William".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия".split(),
    ("m", "cyrillic"): "Иван Сергей Алексей Дмитрий Андрей Михаил Николай Павел Олег Виктор".split(),
    ("f", "greek"): "Μαρία Ελένη Σοφία Κατερίνα Άννα Δήμητρα".split(),
    ("m", "greek"): "Γιώργος Νίκος Δημήτρης Κώστας Πέτρος Παύλος".split(),
}
# Letters that stand for one another, the vowels and consonants of each alphabet, plain and accented.
CLASSES = ("aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóú", "àèìòù", "âêîôû", "äëïöü", "ãõ", "çñ", "ßſ", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ", "0123456789")
# Country calling codes of one and of two digits; all others have three.
CALLING_1 = frozenset("17")
CALLING_2 = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())

_CLASS_OF = {c: cs for cs in CLASSES for c in cs}
_NAMES = {n: key for key, names in FIRST_NAMES.items() for n in names}
_WORD = r"[^\W\d_]"
_UPPER = "A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆ-Ώ"
_SURNAME = rf"(?:(?:von|van|de|del|della|di|du|la) )*[{_UPPER}]{_WORD}+(?:-[{_UPPER}]{_WORD}+)*"
_FORMS = {w: g for g, words in ADDRESS.items() for w in words}
_EMAIL = re.compile(r"(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
_SECRET = re.compile(r"(?i)\b(?:api[_-]?key|access[_-]?key|auth[_-]?token|token|secret|password|passwd|pwd|private[_-]?key)\b[\"']?\s*[:=]\s*[\"']?([^\s\"',;]{6,})")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_IP = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)")
_IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:.])")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,4})?|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)")
_PHONE = re.compile(r"(?<![\w])(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ ./-]?\d{2,5}){1,4}(?!\w)")
_TITLED = re.compile(rf"(?<!\w)({'|'.join(sorted(map(re.escape, _FORMS), key=len, reverse=True))})\.? ((?:[{_UPPER}]{_WORD}+ )?{_SURNAME})")
_NAMED = re.compile(rf"(?<!\w)({'|'.join(_NAMES)}) ({_SURNAME})")
_ANY_FORM = tuple(w for w in _FORMS)
_NAMES_LOWER = {n.lower(): n for n in _NAMES}
_HAS_DIGIT = re.compile(r"\d\D{0,3}\d")


def _folded(c: str) -> str:
    """Lower case where that is one letter whose upper case is `c` again."""
    low = c.lower()
    return low if len(low) == 1 and low.upper() == c else c


def _has_upper(c: str) -> bool:
    up = c.upper()
    return up != c and len(up) == 1 and up.lower() == c


@lru_cache(20_000)
def movable(c: str) -> str | None:
    """The letters or digits that a folded character moves among; None for signs and for a letter that is alone."""
    if c in _CLASS_OF:
        return _CLASS_OF[c]
    if not c.isalnum():
        return None
    near = _alike(c, 64)
    if len(near) == 1:
        near = "".join(x for x in _alike(c, 1024) if len(_alike(x, 64)) == 1)
    return near if len(near) > 1 else None


def _alike(c: str, block: int) -> str:
    """Folded characters without a table, of one kind with `c`, in its block of Unicode."""
    kind, upper, first = unicodedata.category(c), _has_upper(c), ord(c) // block * block
    return "".join(x for x in map(chr, range(first, first + block)) if unicodedata.category(x) == kind and _has_upper(x) == upper and x not in _CLASS_OF and _folded(x) == x)


class Surrogates:
    def __init__(self, key: bytes):
        self.key = key
        self.given: dict[tuple[str, str], str] = {}
        self.shape = lru_cache(50_000)(self._shape)

    def _number(self, *parts: object, bits: int) -> int:
        return int.from_bytes(hmac.new(self.key, "\0".join(map(str, parts)).encode(), hashlib.sha512).digest(), "big") >> (512 - bits)

    def _walk(self, kind: str, x: int, size: int, back: bool) -> int:
        """Feistel permutation of [0, size) and its inverse, walking cycles until the number is in range."""
        half = max(1, (size - 1).bit_length() + 1 >> 1)
        mask = (1 << half) - 1
        while True:
            left, right = x >> half, x & mask
            for k in range(6)[:: -1 if back else 1]:
                if back:
                    left, right = right ^ self._round(kind, k, left, half), left
                else:
                    left, right = right, left ^ self._round(kind, k, right, half)
            x = left << half | right
            if x < size:
                return x

    def _round(self, kind: str, k: int, value: int, half: int) -> int:
        out = 0
        for part in range(0, half, 512):
            out |= self._number(kind, k, part, value, bits=min(512, half - part)) << part
        return out

    def move(self, kind: str, x: int, size: int) -> int:
        if size < 2:
            return x
        shift = 1 + self._number(kind, "shift", size, bits=256) % (size - 1)
        return self._walk(kind, (self._walk(kind, x, size, False) + shift) % size, size, True)

    def _shape(self, kind: str, text: str) -> str:
        """The text moved among texts of its shape; signs stay in place."""
        lower = list(map(_folded, text))
        classes = list(map(movable, lower))
        x, size = 0, 1
        for c, k in zip(lower, classes):
            if k is not None:
                x, size = x * len(k) + k.index(c), size * len(k)
        if size < 2 or any(k is None and c.isalnum() for c, k in zip(lower, classes)):
            return self.code(kind, text)
        name = kind + "|" + "".join("." + c if k is None else "_" + k[0] for c, k in zip(lower, classes))
        x = self.move(name, x, size)
        out = []
        for c, was, k in zip(reversed(lower), reversed(text), reversed(classes)):
            if k is not None:
                x, at = divmod(x, len(k))
                out.append(k[at].upper() if was != c else k[at])
            else:
                out.append(was)
        return "".join(reversed(out))

    def code(self, kind: str, text: str) -> str:
        """A keyed code in place of a value."""
        return f"{kind.partition('|')[0]}-{self._number('code', kind, text, bits=96):024x}"

    # ------------------------------------------------------------ kinds

    def _digits_into(self, kind: str, text: str, digits: str) -> str:
        moved = iter(digits)
        return "".join(next(moved) if c.isdigit() else c for c in text)

    def phone(self, text: str) -> str:
        head = ""
        if text[0] == "+":
            plain = re.sub(r"\D", "", text[1:])
            size = 1 if plain[0] in CALLING_1 else 2 if plain[:2] in CALLING_2 else 3
            head = "+" + plain[:size]
        digits = re.sub(r"\D", "", text)
        moved = digits[: len(head) - 1] + self.shape(f"phone{head}", digits[len(head) - 1 :]) if head else self.shape("phone", digits)
        return self._digits_into("phone", text, moved)

    def card(self, text: str) -> str:
        digits = re.sub(r"\D", "", text)
        if luhn(digits):
            body = self.shape("card-luhn", digits[:-1])
            moved = body + next(c for c in "0123456789" if luhn(body + c))
        else:
            # numbers that fail the check move among those that fail it: the last digit among the nine wrong ones
            right = next(c for c in "0123456789" if luhn(digits[:-1] + c))
            at = (int(digits[-1]) - int(right)) % 10 - 1
            x = self.move(f"card{len(digits)}", int(digits[:-1]) * 9 + at, 10 ** (len(digits) - 1) * 9)
            body = str(x // 9).zfill(len(digits) - 1)
            good = next(c for c in "0123456789" if luhn(body + c))
            moved = body + str((int(good) + 1 + x % 9) % 10)
        return self._digits_into("card", text, moved)

    def iban(self, text: str) -> str:
        plain = text.replace(" ", "")
        body = self.shape("iban" + plain[:2], plain[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
        moved = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(moved) for c in text)

    def ip(self, text: str) -> str:
        x = 0
        for part in text.split("."):
            x = x << 8 | int(part)
        x = self.move("ip", x, 1 << 32)
        return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))

    def ip6(self, text: str) -> str:
        return str(ipaddress.IPv6Address(self.move("ip6", int(ipaddress.IPv6Address(text)), 1 << 128)))

    def email(self, text: str) -> str:
        head, _, end = text.rpartition(".")
        return self.shape("email", head) + "." + end

    def first_name(self, name: str) -> str:
        known = _NAMES_LOWER.get(name.lower())
        if known is None:
            # on through its cycle while it meets a listed name: a permutation of the names that are in no list
            while (name := self.shape("first", name)).lower() in _NAMES_LOWER:
                pass
            return name
        names = FIRST_NAMES[_NAMES[known]]
        found = names[self.move("first" + "".join(_NAMES[known]), names.index(known), len(names))]
        return found.upper() if name.isupper() else found.lower() if name.islower() else found

    def surname(self, text: str) -> str:
        return " ".join(w if w[:1].islower() else self.shape("surname", w) for w in text.split(" "))

    def person(self, text: str) -> str:
        first, _, rest = text.partition(" ")
        if rest:
            return self.first_name(first) + " " + self.surname(rest)
        return self.surname(text)

    def replace(self, kind: str, text: str) -> str:
        found = getattr(self, kind)(text) if kind in ("email", "phone", "card", "iban", "ip", "ip6", "person") else self.shape(kind, text)
        return found if self._free(kind, text, found) else self.code(kind, canonical(kind, text))

    def _free(self, kind: str, text: str, found: str) -> bool:
        """No two entities of a kind may share a surrogate."""
        if len(self.given) > 200_000:
            self.given.clear()
        was = self.given.setdefault((kind, canonical(kind, found)), text)
        return was == text or canonical(kind, was) == canonical(kind, text)


def canonical(kind: str, text: str) -> str:
    """What spellings of one entity have in common."""
    if kind == "ip6" and ":" in text:
        return str(int(ipaddress.IPv6Address(text)))
    if kind == "ip" and "-" in text:
        return text
    return re.sub(r"[^\d+]", "", text) if kind in ("phone", "card") else text.replace(" ", "") if kind == "iban" else ".".join(str(int(p)) for p in text.split(".")) if kind == "ip" else text.lower()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _valid_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _valid_ip6(text: str) -> bool:
    if not any(map(str.isdigit, text)) or text.count(":") < 2:
        return False
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def find_entities(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) that do not overlap, in text order; kinds found earlier in this list win."""
    found: list[tuple[int, int, str]] = []  # in text order

    def add(matches: Iterator[re.Match], kind: str, group: int = 0, keep=lambda s: True) -> None:
        for m in matches:
            a, b = m.span(group)
            at = bisect_left(found, (a, b, ""))
            clear = (at == 0 or found[at - 1][1] <= a) and (at == len(found) or found[at][0] >= b)
            if clear and keep(m[group]):
                found.insert(at, (a, b, kind))

    if "@" in text:
        add(_EMAIL.finditer(text), "email")
    if "=" in text or ":" in text:
        add(_SECRET.finditer(text), "secret", 1)
    if "::" in text or text.count(":") > 6:
        add(_IP6.finditer(text), "ip6", keep=_valid_ip6)
    if _HAS_DIGIT.search(text):
        add(_IBAN.finditer(text), "iban", keep=_valid_iban)
        add(_IP.finditer(text), "ip", keep=lambda s: all(int(p) < 256 for p in s.split(".")))
        add(_SSN.finditer(text), "ssn")
        add(_CARD.finditer(text), "card")
        add(_PHONE.finditer(text), "phone", keep=lambda s: 7 <= sum(c.isdigit() for c in s) <= 15 and (s[0] == "+" or "(" in s or s[0] == "0" and not re.fullmatch(r"[\d.]*\.[\d.]*", s) or bool(re.fullmatch(r"\d{3}[ .-]\d{3}[ .-]\d{4}", s))))
    if any(w in text for w in _ANY_FORM):
        add(_TITLED.finditer(text), "person", 2)
    if not _NAME_SET.isdisjoint(text.split()):
        add(_NAMED.finditer(text), "person")
    return found


_NAME_SET = frozenset(_NAMES)


def pseudonymise(text: str, surrogates: Surrogates) -> tuple[str, Counter]:
    out, at, kinds = [], 0, Counter()
    for a, b, kind in find_entities(text):
        out += [text[at:a], surrogates.replace(kind, text[a:b])]
        at = b
        kinds[kind] += 1
    out.append(text[at:])
    return "".join(out), kinds


_OUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_entities", pa.int64()), ("kinds", pa.string())])


def replace_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_entities, kinds ("card:1,email:2"). No shuffle."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        surrogates = Surrogates(key.encode())
        for batch in batches:
            found = [(None, Counter()) if t is None else pseudonymise(t, surrogates) for t in batch.column(1).to_pylist()]
            yield record_batch(_OUT, {
                "doc_id": batch.column(0), "text": [t for t, _ in found], "n_entities": [k.total() for _, k in found], "kinds": [",".join(f"{n}:{k[n]}" for n in sorted(k)) for _, k in found],
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, text string, n_entities long, kinds string")


def surrogate_collisions(docs: DataFrame, key: str) -> DataFrame:
    """kind, surrogate_sha, entities: surrogates over the whole corpus that more than one entity has. Only hashes leave a task."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("kind", pa.string()), ("entity", pa.string()), ("surrogate", pa.string())])
    digest = lambda kind, s: hashlib.sha256(canonical(kind, s).encode()).hexdigest()

    def run(batches):
        surrogates = Surrogates(key.encode())
        for batch in batches:
            rows = {(k, digest(k, t[a:b]), digest(k, surrogates.replace(k, t[a:b]))) for t in batch.column(0).to_pylist() if t for a, b, k in find_entities(t)}
            yield record_batch(schema, dict(zip(schema.names, zip(*rows)))) if rows else record_batch(schema, {n: [] for n in schema.names})

    pairs = docs.select("text").mapInArrow(run, "kind string, entity string, surrogate string").distinct()
    return pairs.groupBy("kind", F.col("surrogate").alias("surrogate_sha")).agg(F.count("*").alias("entities")).filter("entities > 1")
