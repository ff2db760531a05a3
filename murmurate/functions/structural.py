"""Structured pieces of text: counted, tracked, or replaced by placeholders, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from murmurate.schema import PLACEHOLDERS

# What each kind looks like, in the notation of Java's regular expressions with
# Unicode classes. The kinds, their boundaries and the order of replacement decide the results.
#: A step of a menu path: up to four words, the first with a capital, the others too unless they only join.
_STEP = r"[A-Z][\w&/'-]*(?:\s(?:[A-Z][\w&/'-]*|and|of|the|for)){0,3}"
_HELD = "(?:ctrl|control|alt(?:gr)?|shift|super|win(?:dows)?|cmd|command|meta|fn)"
_PRESSED = (
    f"(?:{_HELD}|tab|esc(?:ape)?|enter|return|space(?:bar)?|del(?:ete)?|backspace|capslock|home|end|pg(?:up|dn)|page(?:up|down)|"
    "ins(?:ert)?|prtsc|up|down|left|right|f(?:1[0-2]|[1-9])|[a-z0-9])"
)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_H = "[A-Fa-f0-9]{1,4}"
_UNITS = (
    "mbps mb/s kbps mbit mbs mb's kbytes kb gb tb gig meg k ghz mhz hz kwh kw v fps bit b min mins hr hrs days day months month "
    "years year seconds second ms sec s ft yo pt g x mm millimeter millimeters cm centimeter centimeters lb lbs pound pounds kg kgs "
    "kilogram kilograms tbps gbps mb/sec kb/sec gib mib kib core cores thread threads week weeks m meter meters km kilometer "
    "kilometers in inch inches yd yard yards mile miles gram grams mg milligram milligrams oz ounce ounces ml milliliter milliliters "
    "l liter liters gal gallon gallons qt quart quarts mah ah mw ma kv mph kph knots psi"
).split()

PATTERNS = {
    "menu_navigation_path": rf"(?U)\b{_STEP}(?:\s*>\s*{_STEP})+",
    "keyboard_shortcut": rf"(?iU)\b{_HELD}(?:\s*\+\s*{_PRESSED})+\b",
    "unix_absolute_path": r"(?U)(?<![\w./])/(?:etc|usr|var|home|dev|proc|boot|mnt|media|bin|sbin|opt|root|tmp|lib|lib64|srv|run)(?:/[\w.\-]+)*",
    "url_or_domain": r"""(?iU)\b(?:https?://|www\.)[^\s<>"')]+|(?<!@)\b[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.(?:com|net|org|io|co|gov|edu|info|biz)\b""",
    "email_address": r"(?iU)\b[\w.+-]+@[\w-]+\.[a-z]{2,}(?:\.[a-z]{2,})?\b",
    "phone_number": r"(?U)(?<!\d)(?:\+?1[\s.-]?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}(?!\d)",
    "ipv4_address": rf"(?U)\b(?:{_OCTET}\.){{3}}{_OCTET}\b",
    "ipv6_address": (
        rf"(?U)(?<![:\w.])(?:(?:{_H}:){{7}}{_H}|(?:{_H}:){{1,7}}:|(?:{_H}:){{1,6}}:{_H}|(?:{_H}:){{1,5}}(?::{_H}){{1,2}}"
        rf"|(?:{_H}:){{1,4}}(?::{_H}){{1,3}}|(?:{_H}:){{1,3}}(?::{_H}){{1,4}}|(?:{_H}:){{1,2}}(?::{_H}){{1,5}}"
        rf"|{_H}:(?:(?::{_H}){{1,6}})|:(?:(?::{_H}){{1,7}}|:))(?![:\w.])"
    ),
    "ssn": r"(?U)(?<!\d)(?:\d{3}-\d{2}-\d{4}|\d{9})(?!\d)",
    "binary_dump": r"(?U)\b[01]{8,}\b",
    "hex_dump": r"(?U)\b(?=[0-9A-Fa-f]*[2-9A-Fa-f])[0-9A-Fa-f]{12,}\b",
    "quantity_unit": r"(?iU)\b\d+(?:\.\d+)?(?:" + "|".join(sorted(_UNITS, key=len, reverse=True)) + r")\b",
    "ordinal": r"(?iU)\b\d+(?:st|nd|rd|th)\b",
    "time_of_day": r"(?iU)\b\d+(?:am|pm)\b",
    "approx_range": r"(?U)\b\d+'s\b",
    "aspect_ratio": r"(?iU)\b\d+x\d+\b",
    "video_resolution": r"(?U)\b(?:360|480|720|1080)p?\b",
    "reference_year": r"(?U)\b(?:1[89]\d{2}|20(?:0\d|1[0-5]))\b",
}
#: Kinds that are replaced, in this order, with their column names.
ANONYMIZED = {
    "domain": "url_or_domain", "email": "email_address", "phone": "phone_number", "ssn": "ssn",
    "ipv4": "ipv4_address", "ipv6": "ipv6_address", "menu_path": "menu_navigation_path", "keyboard_shortcut": "keyboard_shortcut",
}
TRACKED = tuple(k for k in PATTERNS if k not in ANONYMIZED.values())


def anonymized(text: Column) -> Column:
    """The text with every anonymized kind replaced by its placeholder, kind after kind."""
    for name, kind in ANONYMIZED.items():
        text = F.regexp_replace(text, PATTERNS[kind], PLACEHOLDERS[name])
    return text


def placeholder_counts(final_text: Column) -> dict[str, Column]:
    """Placeholders that are left in the final text; one that a later kind consumed is not counted."""
    return {
        f"{name}_count": F.regexp_count(final_text, F.lit(rf"(?U)\b{token}\b")).cast("bigint") for name, token in PLACEHOLDERS.items()
    }


def raw_counts(text: Column) -> dict[str, Column]:
    """How often each anonymized kind occurs, without changing the text."""
    return {f"{name}_count": F.regexp_count(text, F.lit(PATTERNS[kind])).cast("bigint") for name, kind in ANONYMIZED.items()}


def matches(text: Column, kind: str) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))


def structural_matches(text: Column) -> Column:
    """Tracked kinds as ``array<struct<match,category>>``, by kind, then by place; for the text as it came."""
    tagged = lambda k: F.transform(matches(text, k), lambda m: F.struct(m.alias("match"), F.lit(k).alias("category")))
    return F.concat(*[tagged(k) for k in TRACKED])


def all_structures(text: Column) -> Column:
    """``map<category,array<match>>`` over all kinds that occur."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), matches(text, k).alias("value")) for k in PATTERNS])
    return F.map_filter(F.map_from_entries(entries), lambda _, v: F.size(v) > 0)
