"""Text cleaning, key/value lists and portable fidelity checks as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def is_blank(value: Column) -> Column:
    return F.trim(F.coalesce(value, F.lit(""))) == ""


def strip(value: Column) -> Column:
    """Removes white space of every kind at both ends."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def collapse(value: Column) -> Column:
    return strip(F.regexp_replace(F.replace(value, F.lit(" "), F.lit(" ")), r"\s+", " "))


def unescape(value: Column) -> Column:
    for name, char in ENTITIES.items():
        value = F.replace(value, F.lit(name), F.lit(char))
    return value


def unescape_numbers(value: Column) -> Column:
    """Decimal character references, each distinct one replaced at all its places."""
    seen = F.array_distinct(F.regexp_extract_all(value, F.lit("&#([0-9]{1,7});"), F.lit(1)))
    letter = lambda n: F.decode(F.unhex(F.lpad(F.hex(n.cast("int")), 8, "0")), "UTF-32")
    known = F.filter(seen, lambda n: n.cast("int").between(1, 0x10FFFF) & ~n.cast("int").between(0xD800, 0xDFFF))
    return F.aggregate(known, value, lambda text, n: F.replace(text, F.concat(F.lit("&#"), n, F.lit(";")), letter(n)))


def official_text(value: Column) -> Column:
    """Markup to text: block ends become line ends, other tags go, white space is collapsed in each line."""
    lines = F.regexp_replace(value, r"(?i)<br\s*/?>|</(p|div|li|tr|h[1-6])>", "\n")
    bare = unescape(unescape_numbers(F.regexp_replace(lines, r"<[^>]*>", " ")))
    return F.array_join(F.filter(F.transform(F.split(bare, "\n"), collapse), lambda x: x != ""), "\n")


def has_markup(value: Column) -> Column:
    return value.rlike(r"(?i)</?[a-z][^>]*>|&(amp|lt|gt|quot|nbsp|#\d+);")


def detail_fields(value: Column) -> Column:
    """'key: value; key: value' as an array of (key, value); duplicates stay, parts without a colon have an empty key."""
    parts = F.filter(F.transform(F.split(value, ";"), strip), lambda x: x != "")

    def cut(part: Column) -> Column:
        at = F.instr(part, ":")
        key = F.when(at > 0, strip(F.substring(part, F.lit(1), at - 1))).otherwise("")
        return F.struct(key.alias("key"), F.when(at > 0, strip(F.substring(part, at + 1, F.length(part)))).otherwise(part).alias("value"))

    return F.transform(parts, cut)


def format_details(fields: Column) -> Column:
    return F.array_join(F.transform(fields, lambda f: F.when(f["key"] == "", f["value"]).otherwise(F.concat(f["key"], F.lit(": "), f["value"]))), "; ")


def distinct_details(value: Column) -> Column:
    """The list without exact repeats, in order of first appearance."""
    return format_details(F.array_distinct(detail_fields(value)))


def badges(value: Column) -> Column:
    return F.filter(F.transform(F.split(value, r"\|"), strip), lambda x: x != "")


def join_badges(values: Column) -> Column:
    return F.array_join(values, " | ")


def numbers(value: Column) -> Column:
    """The numbers of a text, decimal commas as points, in order."""
    return F.transform(F.regexp_extract_all(value, F.lit(r"(\d+(?:[.,]\d+)?)"), F.lit(1)), lambda x: F.replace(x, F.lit(","), F.lit(".")))


def multiset_difference(left: Column, right: Column) -> Column:
    """The values of left beyond their count in right, one for each surplus occurrence kind."""
    count = lambda array, x: F.size(F.filter(array, lambda y: y == x))
    return F.array_sort(F.filter(F.array_distinct(left), lambda x: count(left, x) > count(right, x)))


def measurements(value: Column) -> Column:
    """Distinct (number, unit) pairs, as 'number unit'."""
    pattern = r"(?i)(\d+(?:[.,]\d+)?\s*(?:mm|cm|kg|ml|gb|mb|[gml](?![a-z])))"
    return F.array_distinct(F.transform(F.regexp_extract_all(value, F.lit(pattern), F.lit(1)), lambda x: F.lower(F.regexp_replace(F.replace(x, F.lit(","), F.lit(".")), r"\s+", ""))))


def fidelity_findings(source: Column, target: Column) -> Column:
    """Portable rules on a text and its rendering; ids in a fixed order."""
    rules = [
        ("EMPTY_REQUIRED_FIELD", ~is_blank(source) & is_blank(target)),
        ("EMPTY_SOURCE_TARGET_NONEMPTY", is_blank(source) & ~is_blank(target)),
        ("NULL_UNDEFINED_RESIDUAL", F.coalesce(F.lower(target), F.lit("")).rlike(r"\b(null|undefined|nan|none)\b")),
        ("HTML_RESIDUAL", F.coalesce(has_markup(target), F.lit(False))),
        ("NUMERIC_DROPPED", F.size(multiset_difference(numbers(F.coalesce(source, F.lit(""))), numbers(F.coalesce(target, F.lit(""))))) > 0),
        ("NUMERIC_ADDED", F.size(multiset_difference(numbers(F.coalesce(target, F.lit(""))), numbers(F.coalesce(source, F.lit(""))))) > 0),
        ("UNIT_DROPPED", F.size(F.array_except(measurements(F.coalesce(source, F.lit(""))), measurements(F.coalesce(target, F.lit(""))))) > 0),
        ("UNIT_ADDED", F.size(F.array_except(measurements(F.coalesce(target, F.lit(""))), measurements(F.coalesce(source, F.lit(""))))) > 0),
    ]
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules]))


def jaccard(left: Column, right: Column) -> Column:
    return F.coalesce(F.try_divide(F.size(F.array_intersect(left, right)).cast("double"), F.size(F.array_union(left, right))), F.lit(0.0))
