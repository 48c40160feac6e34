"""Text measurements as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelight import contracts

#: Patterns that results depend on.
STAMP = r"\b([A-Z]{3,8})[-_]?(\d{4,10})\b"
LABEL = r"(?iu)\bPage\s+(\d{1,4})\s*(?:of|/)\s*(\d{1,4})\b"
SPACER = r"(?iu)intentionally\s+(left\s+)?blank|this\s+page\s+is\s+blank"
TOKEN = r"[A-Za-z][A-Za-z'-]{3,}"
TERMINAL = ".!?:;”’\")]}"
IDENTIFIER = r"(?iu)\b[A-Z]{2,}[-/][A-Z0-9][A-Z0-9-]{2,}\b|\b(?:No|Case|Docket|Report|Publication)\.?\s*[:#]?\s*[A-Z0-9][A-Z0-9.-]{2,}\b"
MONTH = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
DATE = rf"(?iu)\b\d{{1,2}}[/-]\d{{1,2}}[/-]\d{{2,4}}\b|\b\d{{4}}-\d{{2}}-\d{{2}}\b|\b{MONTH}\.?\s+\d{{1,2}},?\s+\d{{4}}\b|\b\d{{1,2}}\s+{MONTH}\.?\s+\d{{4}}\b"
#: Text that is never identity.
NOISE = (r"(?U)^\W*$", r"(?iu)^(?:page\s*)?\d{1,4}(?:\s*of\s*\d{1,4})?$", r"(?iu)^https?://|^www\.", r"^\S+@\S+\.\S+$", r"^[\d\s().+-]{7,}$", r"(?iu)intentionally\s+(?:left\s+)?blank")
#: Named page sizes in points, portrait.
PAGE_SIZES = (("Letter", 612.0, 792.0), ("Legal", 612.0, 1008.0), ("A4", 595.0, 842.0), ("A3", 842.0, 1191.0), ("Ledger", 792.0, 1224.0), ("Executive", 522.0, 756.0))
SIZE_TOLERANCE = 0.05
#: Font classes, the first that matches.
FONT_CLASSES = (
    ("mono", r"(?i)courier|mono|consol|lucida\s*console"),
    ("serif", r"(?i)times|georgia|garamond|book|roman|serif|minion|cambria|palatino|century"),
    ("sans", r"(?i)arial|helvetica|calibri|verdana|tahoma|segoe|futura|gill|sans"),
)


def rounded(x: Column, places: int) -> Column:
    """Half away from zero by scaling, the same in every engine."""
    scale = 10.0**places
    return F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale


def normalized(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))


def stripped(text: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def words(norm: Column) -> Column:
    """Of normalised text."""
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def lines(text: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\R"), stripped), lambda x: x != "")


def masked_edge(line: Column) -> Column:
    return F.coalesce(F.left(F.lower(F.regexp_replace(line, r"\d", "#")), F.lit(48)), F.lit(""))


def font_name(raw: Column) -> Column:
    name = F.split_part(F.regexp_replace(raw, r"^[A-Z]{6}\+", ""), F.lit(","), F.lit(1))
    return F.regexp_replace(name, r"(?i)[-_](Bold|Italic|Oblique|Regular|Light|Medium|Roman|BoldItalic)$", "")


def font_class(name: Column) -> Column:
    out = F.lit("other")
    for label, pattern in reversed(FONT_CLASSES):
        out = F.when(name.rlike(pattern), label).otherwise(out)
    return out


def size_class(width: Column, height: Column) -> Column:
    short, long = F.least(width, height), F.greatest(width, height)
    out = F.lit("other")
    for label, w, h in reversed(PAGE_SIZES):
        out = F.when((F.abs(short - w) <= w * SIZE_TOLERANCE) & (F.abs(long - h) <= h * SIZE_TOLERANCE), label).otherwise(out)
    return out


def last_match(text: Column, pattern: str, group: int) -> Column:
    """A group of the last match, null without one."""
    return F.nullif(F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1)), F.lit(""))


def first_match(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def overlap(a: Column, b: Column) -> Column:
    """Overlap coefficient of two sets, null if either is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least)


def uppercase_ratio(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.when(letters > 0, rounded(F.length(F.regexp_replace(text, r"[^\p{Lu}]", "")) / letters, 4)).otherwise(F.lit(0.0))


def digit_ratio(text: Column) -> Column:
    solid = F.length(F.regexp_replace(text, r"(?U)\s", ""))
    return F.when(solid > 0, rounded(F.length(F.regexp_replace(text, r"[^0-9]", "")) / solid, 4)).otherwise(F.lit(0.0))


def is_noise(text: Column) -> Column:
    out = F.lit(False)
    for pattern in NOISE:
        out |= text.rlike(pattern)
    return out


def lexical_tokens(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"[A-Za-z][A-Za-z'’\-]*|\d+[A-Za-z]*"), F.lit(0)), F.lower)


def ir_tokens(text: Column) -> Column:
    return F.filter(lexical_tokens(text), lambda w: (F.length(w) >= 2) & ~w.rlike(r"^[0-9]+$"))


def word_list(*names: str) -> list[str]:
    """The words of contract lists; isin() looks them up by hash, also within an array's function."""
    return [w for n in names for w in contracts.load("identity")[n]]


def word_array(*names: str) -> Column:
    return F.array(*[F.lit(w) for w in word_list(*names)])


def evaluation_tokens(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    return F.array_distinct(F.filter(found, lambda w: (F.length(w) > 1) & ~F.array_contains(word_array("evaluation_stopwords"), w)))
