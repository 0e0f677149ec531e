"""Facts that a product states in several fields, and whether they agree: tables of patterns and one rule for each kind of fact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.evidence import folded, measure_kind, text_of

# fixed values: how fields state amounts, sizes and names of their own
NUMBER = r"\d+(?:[.,]\d+)?"
UNIT = (
    r"unidades?|uds?\.?|piezas?|pares?|hojas?|gramos?|kg|g|mg|mcg|µg|ug|litros?|l|ml|cl|cm|mm|m|pulgadas?|in|v(?:oltios?)?|w(?:atios?)?|mah|gb|mb|denier|días?|meses?|años?|%"
)
AMOUNT = rf"(?i)({NUMBER})\s*({UNIT})\b"
LABELLED = rf"(?i)([^:;]+):\s*({NUMBER})\s*({UNIT})\b"
SIZE = r"(?i)\b(?:talla|tamaño|size)\s*[:：-]?\s*([0-9]{1,3}\s*(?:[-/]\s*[0-9]{1,3})?|[xsml]{1,4}(?:\s*[-/]\s*[xsml]{1,4})?)\b"
POLLUTION = r"(?i)<[^>]+>|\bnull\b|\bundefined\b|añadir a tus favoritos|加入收藏|[㐀-鿿]"
ARTICLE = r"(?i)n[uú]mero\s+del\s+art[ií]culo\s*(?:[:：]\s*)?(\d+)"
#: A flag, the pattern of the value, and the fields that must not state two different ones.
STATED = (
    ("PRODUCT_OBJECT_CONFLICT", r"(?i)(?:tipo\s+de\s+(?:producto|art[ií]culo)|producto)\s*:\s*([^;,.]+)", ("name", "description", "details")),
    ("MATERIAL_CONFLICT", r"(?i)material\s*:\s*([^;,.]+)", ("spec", "description", "details")),
    ("BRAND_CONFLICT", r"(?i)\bmarca\s*[:：\t]\s*([^;\n,.]+)", ("name", "cat1", "cat2", "spec", "description", "details")),
    ("MODEL_CONFLICT", r"(?i)\bmodelo\s*[:：\t]\s*([^;\n,.]+)", ("name", "cat1", "cat2", "spec", "description", "details")),
)
FIELDS = ("name", "cat1", "cat2", "spec", "description", "details")


def groups_of(text: Column, pattern: str, *groups: int) -> Column:
    """The matches of a pattern, as structs g1, g2, … of the groups."""
    found = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in groups]
    return F.arrays_zip(*found)


def plain(value: Column) -> Column:
    return F.trim(F.regexp_replace(folded(value), r"\s+", " "))


def amounts(text: Column) -> Column:
    """Distinct (kind, number, unit) of a text; a unit's kind is what makes two amounts comparable."""
    unit = lambda x: F.regexp_replace(F.lower(x["g2"]), r"\.+$", "")
    return F.array_distinct(F.transform(groups_of(text, AMOUNT, 1, 2), lambda x: F.struct(measure_kind(unit(x)).alias("kind"), F.replace(x["g1"], F.lit(","), F.lit(".")).cast("double").alias("number"), unit(x).alias("unit"))))


def of_kind(found: Column, kind: Column) -> Column:
    return F.array_sort(F.transform(F.filter(found, lambda x: x["kind"] == kind), lambda x: F.struct(x["number"].alias("number"), x["unit"].alias("unit"))))


def units_of(found: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: x["unit"])))


def disputed(left: Column, right: Column, view) -> Column:
    """Whether two lists of amounts share a kind of which `view` shows different things."""
    kinds = F.array_intersect(F.transform(left, lambda x: x["kind"]), F.transform(right, lambda x: x["kind"]))
    return F.exists(kinds, lambda kind: view(of_kind(left, kind)) != view(of_kind(right, kind)))


def relabelled(text: Column) -> Column:
    """Whether a label stands before two different amounts."""
    found = F.array_distinct(F.transform(groups_of(text, LABELLED, 1, 2, 3), lambda x: F.struct(F.trim(F.regexp_replace(F.lower(x["g1"]), r"\s+", " ")).alias("label"), F.replace(x["g2"], F.lit(","), F.lit(".")).cast("double").alias("number"), F.regexp_replace(F.lower(x["g3"]), r"\.+$", "").alias("unit"))))
    labels = F.transform(found, lambda x: x["label"])
    return F.size(labels) > F.size(F.array_distinct(labels))


def stated(pattern: str, *texts: Column) -> Column:
    """Distinct values that texts state, without case and accents."""
    found = F.flatten(F.array(*[F.regexp_extract_all(t, F.lit(pattern), F.lit(1)) for t in texts]))
    return F.array_distinct(F.filter(F.transform(found, plain), lambda x: x != ""))


def consistency_flags(fields: dict[str, Column], rules: tuple = STATED) -> Column:
    """Sorted flags of a product whose fields contradict each other; fields that are absent are empty."""
    text = {f: text_of(fields[f]) if f in fields else F.lit("") for f in FIELDS}
    spec, others = amounts(text["spec"]), [amounts(text["details"]), amounts(text["description"])]
    numeric = disputed(spec, others[0], lambda x: x) | disputed(spec, others[1], lambda x: x) | relabelled(text["details"])
    unit = disputed(spec, others[0], units_of) | disputed(spec, others[1], units_of)
    sizes = [F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text[f], F.lit(SIZE), F.lit(1)), lambda x: F.lower(F.regexp_replace(x, r"\s+", ""))))) for f in ("spec", "details")]
    ranged = (F.size(sizes[0]) > 0) & (F.size(sizes[1]) > 0) & (sizes[0] != sizes[1])
    found = [F.when(numeric, "NUMERIC_CONFLICT"), F.when(unit, "UNIT_CONFLICT"), F.when(ranged, "SIZE_RANGE_CONFLICT")]
    found += [F.when(F.size(stated(pattern, *[text[f] for f in names])) > 1, flag) for flag, pattern, names in rules]
    return F.array_sort(F.array_compact(F.array(*found)))


def quality_issues(fields: dict[str, Column], sku: Column) -> Column:
    """Sorted issues of a source: empty and polluted fields, details without the product's own article number."""
    text = {f: text_of(fields[f]) if f in fields else F.lit("") for f in FIELDS}
    article = F.regexp_extract(text["details"], ARTICLE, 1)
    found = [F.when(text[f] == "", f"EMPTY_{f.upper()}") for f in FIELDS] + [F.when(text[f].rlike(POLLUTION), f"POLLUTED_{f.upper()}") for f in FIELDS]
    found.append(F.when(article == "", "DETAIL_SKU_MISSING").when(article != F.trim(sku), "DETAIL_SKU_MISMATCH"))
    return F.array_sort(F.array_compact(F.array(*found)))
