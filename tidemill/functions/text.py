"""Text expressions: splitting, cleaning HTML, shortening and filtering descriptions."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentences matching any of these are advertising.
PROMO_PATTERNS = [
    r"(?i)\bđây là sản phẩm\b.*",
    r"(?i)\bshop\b.*",
    r"(?i)\bchi(ỉ|́|̣)?\s+co(́|́)?\b.*",
    r"(?i)\btặng kèm\b.*",
    r"(?i)\bkhuyến mãi\b.*",
    r"(?i)\bcam kết\b.*",
    r"(?i)\bmiễn phí\b.*",
    r"(?i)\bmiễn phí vận chuyển\b.*",
    r"(?i)\bliên hệ\b.*",
    r"(?i)\bgiao hàng\b.*",
    r"(?i)\bthanh toán\b.*",
    r"(?i)http[s]?://\S+",
    r"(?i)www\.\S+",
    r"(?i)\bhot\b.*",
    r"(?i)\bnew\b.*",
    r"(?i)\bbest seller\b.*",
]

SENTENCE_GAP = r"(?U)(?<=[.!?])\s+"
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"

HIDDEN_BLOCKS = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\z)"
TAGS = r"""(?s)</?[a-zA-Z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[!?][^>]*>"""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with the value computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def part(text: Column, separator: str, index: int) -> Column:
    """The ``index``-th piece from 0; null where there is none."""
    return F.get(F.split(text, re.escape(separator)), F.lit(index))


def email_domain(email: Column) -> Column:
    return part(email, "@", 1)


def full_name(*names: Column) -> Column:
    """Names joined by a blank; null if any of them is null."""
    spaced = [piece for name in names for piece in (F.lit(" "), name)]
    return F.concat(*spaced[1:])


def squeeze(text: Column) -> Column:
    """Trim and turn every run of white space into one blank."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def last_segment(text: Column, separator: str = "/") -> Column:
    return F.substring_index(text, separator, -1)


# The characters with Unicode's White_Space property: fixed values.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim white space of any kind."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def present(text: Column) -> Column:
    """The text, or null where it is blank."""
    return F.when(text.rlike(r"(?U)\S"), text)


def first_truthy(*candidates: Column) -> Column:
    """The first string that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def or_missing(text: Column, default: str = "N/A") -> Column:
    return F.coalesce(text, F.lit(default))


def valid_email(email: Column) -> Column:
    return F.coalesce(email.rlike(EMAIL_PATTERN), F.lit(False))


def email_or_default(name: Column, email: Column, domain: str = "default.com") -> Column:
    return F.when(valid_email(email), email).otherwise(F.concat(name, F.lit(f"@{domain}")))


# Names that HTML accepts without a semicolon, longest first, so that the longest one is found.
BARE_NAMES = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n)))
NAME = rf"^([A-Za-z][A-Za-z0-9]*;|{BARE_NAMES})"
NUMBER = r"^#(?:[xX]0*([0-9a-fA-F]+)|0*([0-9]+));?"
COMMON = ["amp;", "nbsp;", "lt;", "gt;", "quot;"]


def _literal_map(pairs: dict[str, str]) -> Column:
    """A constant map; as one literal, which Spark parses once while it plans."""
    return F.from_json(F.lit(json.dumps(pairs)), "MAP<STRING, STRING>")


def _windows_1252() -> dict[int, int]:
    """Numbers 128 to 159 stand for the characters that Windows-1252 has there."""
    found = {i: bytes([i]).decode("cp1252", "ignore") for i in range(0x80, 0xA0)}
    return {i: ord(c) for i, c in found.items() if c}


def _number(code: Column) -> Column:
    """The character of a number; the replacement character for one that is none."""
    moved = F.create_map(*[F.lit(n) for pair in _windows_1252().items() for n in pair])
    moved = F.coalesce(F.element_at(moved, code), code)
    valid = moved.between(1, 0xD7FF) | moved.between(0xE000, 0x10FFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, moved).otherwise(0xFFFD)), 8, "0")), "UTF-32")


def _reference(piece: Column) -> Column:
    """Decode the character reference that ``piece`` (text after an ``&``) starts with."""

    def numeric(piece: Column) -> Column:
        hexadecimal, decimal = F.regexp_extract(piece, NUMBER, 1), F.regexp_extract(piece, NUMBER, 2)
        # More digits than any character has make no character.
        code = F.when(F.length(hexadecimal) > 6, -1).when(hexadecimal != "", F.conv(hexadecimal, 16, 10).try_cast("int"))
        code = F.coalesce(code, F.when(F.length(decimal) > 7, -1).otherwise(decimal.try_cast("int")))
        return F.concat(let(code, _number), F.regexp_replace(piece, NUMBER, ""))

    def named(piece: Column) -> Column:
        def replaced(name: Column) -> Column:
            known = F.element_at(_literal_map({n: c for n, c in html5.items() if n not in COMMON}), name)
            for common in COMMON:
                known = F.when(name == common, html5[common]).otherwise(known)
            whole = F.concat(known, F.substring(piece, F.length(name) + 1, F.length(piece)))
            # An unknown name with a semicolon may still begin with one that needs none.
            bare = F.regexp_extract(piece, f"^({BARE_NAMES})", 1)
            short = let(bare, lambda b: F.when(b != "", F.concat(
                F.element_at(_literal_map({n: c for n, c in html5.items() if not n.endswith(";")}), b),
                F.substring(piece, F.length(b) + 1, F.length(piece)),
            )))
            return F.coalesce(whole, short, F.concat(F.lit("&"), piece))

        return let(F.regexp_extract(piece, NAME, 1), replaced)

    return F.when(piece.rlike(NUMBER), numeric(piece)).when(piece.rlike(NAME), named(piece)).otherwise(
        F.concat(F.lit("&"), piece)
    )


def decode_entities(text: Column) -> Column:
    """Replace HTML character references in one pass, so ``&amp;lt;`` becomes ``&lt;``."""

    def joined(pieces: Column) -> Column:
        return F.array_join(
            F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(_reference(p))), ""
        )

    return F.when(text.isNotNull(), let(F.split(text, "&"), joined))


def html_to_text(html: Column) -> Column:
    """Visible text: no comments, scripts or styles; tags act as blanks."""
    shown = F.regexp_replace(F.regexp_replace(html, HIDDEN_BLOCKS, " "), TAGS, " ")
    return squeeze(decode_entities(shown))


def first_sentences(text: Column, count: int = 2) -> Column:
    return F.array_join(F.slice(F.split(text, SENTENCE_GAP, count + 1), 1, count), " ")


def shorten(text: Column, limit: int) -> Column:
    """At most ``limit`` characters; a cut inside a sentence drops the broken word, adds dots."""

    def ended(cut: Column) -> Column:
        dotted = F.concat(F.regexp_replace(cut, r" [^ ]*$", ""), F.lit("..."))
        return F.when(cut.rlike(r"[.!?]$"), cut).otherwise(dotted)

    def shortened(whole: Column) -> Column:
        cut = F.regexp_replace(F.left(whole, F.lit(limit)), r"(?U)\s+$", "")
        return F.when(F.length(whole) <= limit, whole).otherwise(let(cut, ended))

    return let(text, shortened)


def any_of(patterns: Sequence[str]) -> str:
    """One regular expression that finds whatever any of the patterns finds.

    Patterns that start at a word boundary share one test for it.
    """
    start = r"(?i)\b"
    words = [p.removeprefix(start) for p in patterns if p.startswith(start)]
    others = [f"(?:{p})" for p in patterns if not p.startswith(start)]
    shared = [rf"(?:{start}(?:{'|'.join(words)}))"] if words else []
    return "(?U)" + "|".join(shared + others)


ODD_CASES = {"İ": "i", "ı": "i", "ſ": "s"}  # equal to these letters without regard to case, though not once lower-cased


def _folded(text: Column | str):
    """Lower case, in which letters that a regular expression takes as equal without case are equal."""
    for sign, letter in ODD_CASES.items():
        text = text.replace(sign, letter) if isinstance(text, str) else F.replace(text, F.lit(sign), F.lit(letter))
    return text.lower() if isinstance(text, str) else F.lower(text)


@lru_cache
def _variants() -> dict[str, set[str]]:
    found = {}
    for sign in map(chr, range(0x80, 0x10000)):
        if sign not in ODD_CASES:
            found.setdefault(sign.upper(), set()).add(sign.lower())
    return found


def opening_letters(pattern: str) -> str | None:
    """The letters, digits and blanks a pattern's finds must begin with; None if fewer than three are sure."""
    body, depth = pattern.removeprefix("(?i)").removeprefix(r"\b"), 0
    for sign in re.sub(r"\\.", "", body):
        depth += (sign == "(") - (sign == ")")
        if sign == "|" and not depth:
            return None
    letters = re.match(r"[^\W_ ][^\W_]*(?: [^\W_]+)*", body)
    found = letters.group() if letters else ""
    if body[len(found) : len(found) + 1] in ("?", "*", "{"):
        found = found[:-1]
    found = _folded(found)
    plain = all(_variants().get(sign.upper(), set()) <= {sign} for sign in found)
    return found if len(found) >= 3 and plain else None


def drop_sentences(text: Column, patterns: Sequence[str] = PROMO_PATTERNS) -> Column:
    """Remove every sentence in which one of the patterns is found.

    A text in which none of the patterns can begin is not searched sentence by sentence.
    """
    unwanted, letters = any_of(patterns), [opening_letters(p) for p in patterns]

    def kept(sentences: Column, possible: Column) -> Column:
        wanted = lambda s: (s != "") & ~F.when(possible, s.rlike(unwanted)).otherwise(False)
        return F.array_join(F.filter(sentences, wanted), " ")

    def searched(whole: Column) -> Column:
        sentences = F.split(whole, SENTENCE_GAP)
        if not all(letters):
            return kept(sentences, F.lit(True))
        some = lambda folded: F.greatest(*[F.contains(folded, F.lit(x)) for x in dict.fromkeys(letters)], F.lit(False))
        return let(let(_folded(whole), some), lambda possible: kept(sentences, possible))

    return let(strip(text), searched)


def describe_product(html: Column, limit: int = 400, drop_promotions: bool = True) -> Column:
    """The short description of a product page; empty text where there is none."""
    text = shorten(first_sentences(html_to_text(html)), limit)
    if drop_promotions:
        text = shorten(drop_sentences(text), limit)
    return F.coalesce(text, F.lit(""))
