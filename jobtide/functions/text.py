"""Text as Column expressions: white space, sentinels, markup, tokens, hashes."""

from __future__ import annotations

import json
import zlib
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings that mean "missing" (case matters).
SENTINELS = ("", "nan", "NaN", "None", "none", "NA", "na", "N/A", "n/a", "null")
# Entities that markup of postings uses, for a decoding that stays in the JVM.
BASIC_ENTITIES = (("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&auml;", "ä"), ("&ouml;", "ö"), ("&uuml;", "ü"), ("&Auml;", "Ä"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"), ("&szlig;", "ß"), ("&euro;", "€"), ("&ndash;", "–"), ("&mdash;", "—"), ("&bull;", "•"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))
# Blocks of pictographs, arrows and shapes that are not text.
PICTOGRAPHS = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2600}-\x{27BF}\x{1F900}-\x{1F9FF}\x{25A0}-\x{25FF}\x{2190}-\x{21FF}]+"
CHARS_PER_TOKEN = 3.5


#: Unicode white space: what (?U)\\s matches (fixed values).
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space at the ends, Unicode white space included (trim() alone knows U+0020 only). No pattern is run."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def squeeze(c: Column) -> Column:
    """Every run of white space becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def null_if_sentinel(c: Column, *, trimmed: bool = False) -> Column:
    """NULL where the value (or its stripped form) is one of SENTINELS."""
    return F.when(~(strip(c) if trimmed else c).isin(*SENTINELS), c)


def blank(c: Column) -> Column:
    return c.isNotNull() & (strip(c) == "")


#: Named entities are dealt by checksum over so many short tables.
_TABLES = 256


def _entity_tables() -> str:
    """All names of HTML 5, with and without semicolon as they are defined, as a JSON list of texts: U+0001, name, U+0002, value in two characters."""
    tables = [""] * _TABLES
    for name, value in html5.items():
        tables[zlib.crc32(name.encode()) % _TABLES] += f"\x01{name}\x02{value:\x03<2}"
    return json.dumps(tables)


def let(value: Column, use) -> Column:
    """use(value) with the value computed once per row: a lambda over an expression would compute it for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _code_point(n: Column) -> Column:
    """The character of a number, as HTML 5 has it: Windows-1252 for 128 to 159, U+FFFD for what is no character, nothing for controls and noncharacters."""
    windows = {k: bytes([k]).decode("cp1252", "ignore") or chr(k) for k in range(0x80, 0xA0)}
    known = F.when(n == 0, "\ufffd").when(n == 0xFEFF, "\ufeff")
    for k, c in windows.items():
        known = known.when(n == k, c)
    gone = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return known.when((n > 0x10FFFF) | n.between(0xD800, 0xDFFF), "\ufffd").when(gone, "").otherwise(plain)


def unescape_entities(c: Column, *, only: Sequence[str] | None = None) -> Column:
    """All named and numeric character references, as browsers read them: names without a semicolon where HTML 5 knows them so, longest first.

    Each part behind a sign of & is read by itself, since no reference holds that sign. Texts without one are left as they are.
    With `only`, references written otherwise than one of these (with & and semicolon) stay as they are.
    """
    tables = F.from_json(F.lit(_entity_tables()), "array<string>")
    bare = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))

    def named(name: Column) -> Column:
        """The value of a name that HTML 5 has, else NULL."""
        table = F.get(tables, F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(_TABLES)).cast("int"))
        at = lambda t: F.instr(t, F.concat(F.lit("\x01"), name, F.lit("\x02")))
        return F.when(name.rlike("^[A-Za-z0-9]+;?$"), let(table, lambda t: F.when(at(t) > 0, F.rtrim(F.substr(t, at(t) + F.length(name) + 2, F.lit(2)), F.lit("\x03")))))

    def number(digits: Column, base: int, most: int) -> Column:
        short = F.ltrim(digits, F.lit("0"))
        return let(F.when(F.length(short) > most, 0x110000).when(short == "", 0).otherwise(F.conv(short, base, 10).cast("int")), _code_point)

    def read(p: Column, reference: Column) -> Column:
        rest = lambda size: F.substr(p, size + 1)
        start = F.regexp_extract(reference, f"^(?:{bare})", 0)
        other = let(start, lambda s: F.when(s != "", F.concat(named(s), rest(F.length(s)))).otherwise(F.concat(F.lit("&"), p)))
        return (
            F.when(reference == "", F.concat(F.lit("&"), p))
            .when(reference.rlike("^#[0-9]"), F.concat(number(F.regexp_extract(reference, "[0-9]+", 0), 10, 7), rest(F.length(reference))))
            .when(reference.rlike("^#[xX]"), F.concat(number(F.regexp_extract(reference, "^#[xX]([0-9a-fA-F]+)", 1), 16, 6), rest(F.length(reference))))
            .otherwise(F.coalesce(F.concat(named(reference), rest(F.length(reference))), other))
        )

    def chosen(p: Column, reference: Column) -> Column:
        if only is None:
            return read(p, reference)
        return F.when(reference.isin(*[e.removeprefix("&") for e in only]), read(p, reference)).otherwise(F.concat(F.lit("&"), p))

    def part(p: Column) -> Column:
        return let(F.regexp_extract(p, r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)", 0), lambda reference: chosen(p, reference))

    whole = let(F.split(c, "&", -1), lambda parts: F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, 1 << 30), part), "")))
    return F.when(c.contains("&"), whole).otherwise(c)


def decode_basic_entities(c: Column) -> Column:
    for entity, char in BASIC_ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def clean_html(c: Column, *, all_entities: bool = True, only: Sequence[str] | None = None) -> Column:
    """Tags become spaces, entities their characters; of all entities those of `only`, where it is given."""
    bare = F.regexp_replace(c, "<[^>]+>", " ")
    return unescape_entities(bare, only=only) if all_entities else decode_basic_entities(bare)


def clean_special_chars(c: Column) -> Column:
    """Pictographs, slash runs, hashes (but of C# and F#), asterisks and table signs become spaces."""
    for pattern in (PICTOGRAPHS, "//+", "(?<![CF])#", r"\*+", r"[|\\~`]"):
        c = F.regexp_replace(c, pattern, " ")
    return c


def normalize_whitespace(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n"))


def preprocess_description(c: Column, *, all_entities: bool = True) -> Column:
    """Markup, signs and white space; NULL and empty pass through."""
    return F.when(c.isNull() | (c == ""), c).otherwise(normalize_whitespace(clean_special_chars(clean_html(c, all_entities=all_entities))))


def strip_markdown_escapes(c: Column) -> Column:
    """Backslashes before any of the signs that markdown escapes."""
    return F.when(c.contains("\\"), F.regexp_replace(c, r"\\([.\-+*(){}|^$#!@&~`\[\]])", "$1")).otherwise(c)


def strip_four_escapes(c: Column) -> Column:
    """Only the escapes of - + _ and . (the form that evidence checks use)."""
    for sign in "-+_.":
        c = F.replace(c, F.lit("\\" + sign), F.lit(sign))
    return c


def estimate_tokens(c: Column) -> Column:
    return F.floor(F.length(c) / CHARS_PER_TOKEN).cast("long")


def truncate_description(c: Column, max_tokens: int, *, marker: str = "\n[TRUNCATED]", separators: Sequence[str] = (". ", ".\n", "! ", "? ")) -> Column:
    """At most `max_tokens`, cut behind the last sentence end of the final 200 characters if there is one."""
    limit = int(max_tokens * CHARS_PER_TOKEN)
    head = F.substring(c, 1, limit)
    cut = head
    for sep in reversed(separators):
        at = F.instr(F.reverse(head), F.lit(sep[::-1]))
        cut = F.when((at > 0) & (at <= 200), F.left(head, F.length(head) - at - (len(sep) - 2))).otherwise(cut)
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(cut, F.lit(marker)))


def description_hash(c: Column) -> Column:
    """SHA-256 of the text with squeezed white space."""
    return F.sha2(squeeze(F.coalesce(c, F.lit(""))), 256)


def row_id(url: Column) -> Column:
    """First 12 hex digits of the SHA-256 of a URL."""
    return F.substring(F.sha2(url, 256), 1, 12)


def tokens(c: Column, pattern: str = "[^a-zà-ÿ]+") -> Column:
    """Distinct lower-case words of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(c), pattern)), "")


def casing_score(c: Column) -> Column:
    """Per word: 2 for an upper-case start, 1 for other than all lower or all upper case, -1 for all lower case. Blank: 0."""

    def word(w: Column) -> Column:
        cased = F.lower(w) != F.upper(w)
        start, is_lower, is_upper = F.substring(w, 1, 1), cased & (w == F.lower(w)), cased & (w == F.upper(w))
        upper_start = (start != F.lower(start)) & (start == F.upper(start))
        return F.when(upper_start, 2).otherwise(0) + F.when(~is_lower & ~is_upper, 1).otherwise(0) + F.when(is_lower, -1).otherwise(0)

    words = F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\s+"), lambda w: w != "")
    return F.aggregate(words, F.lit(0), lambda a, w: a + word(w))


def concatenated(c: Column, limit: int = 10) -> Column:
    """'concatenated' where lower case meets upper case more than `limit` times, else 'clean'."""
    return F.when(F.regexp_count(F.coalesce(c, F.lit("")), F.lit("[a-z][A-Z]")) > limit, "concatenated").otherwise("clean")
