"""What is left of a source language in a rendering: words, kinds of Latin tokens, numbers that are written out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.evidence import has_cjk

# fixed values: words and forms that the checks know
FUNCTION_WORDS = "de del la el los las para con sin una uno un y en por más color colores tamaño unidades piezas pack set".split()
TECHNICAL = r"^(?:USB(?:-[A-Z])?|LED|LCD|DIY|FSC|E27|A\d+|D\d+|XL?|[A-Z]{1,6}\d{2,}[A-Z0-9-]*|[A-Z]{2,6}|\d+(?:mg|mcg|mAh|V|W|D))$"
MODEL = r"^[A-Z0-9][A-Z0-9-]{1,15}$"
CARDINALS = {"dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9", "diez": "10"}
COUNTED = "unidades piezas pares rollos dispositivos puertos pestañas altavoces bolsillos modos horas pendientes cajas colores posiciones".split()
TENS = "veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien ciento doscientos trescientos cuatrocientos quinientos seiscientos setecientos ochocientos novecientos mil".split()
DIGITS = {"零": "0", "〇": "0", "一": "1", "两": "2", "二": "2", "三": "3", "四": "4", "五": "5", "六": "6", "七": "7", "八": "8", "九": "9"}
CONNECTORS, UNIT_SIGNS = "合到至折×xX/+-", "个件只片颗粒张页套人组支条把盒包瓶罐袋卷双位端口环块层伏瓦毫升克公斤厘米毫米小时款"
LATIN = "A-Za-zÁÉÍÓÚÜÑáéíóúüñ"


def latin_words(value: Column) -> Column:
    """Runs of Latin letters outside addresses."""
    prose = F.regexp_replace(F.coalesce(value, F.lit("")), r"(?i)https?://[^\s;；]+", "")
    return F.regexp_extract_all(prose, F.lit(f"([{LATIN}]+)"), F.lit(1))


def is_residue(word: Column, allowed: Column) -> Column:
    """A word that is neither allowed nor technical and has over two letters or is a function word."""
    plain = ~F.array_contains(allowed, F.lower(word)) & ~word.rlike(TECHNICAL)
    return plain & ((F.length(word) > 2) | F.lower(word).isin(*[w for w in FUNCTION_WORDS if len(w) <= 2], "o"))


def ordinary_words(value: Column, allowed: Column | None = None) -> Column:
    """The words of a text that are left untranslated, in order."""
    known = F.array().cast("array<string>") if allowed is None else F.transform(allowed, lambda w: F.lower(w))
    return F.filter(latin_words(value), lambda w: is_residue(w, known))


def latin_class(token: Column, brands: Column) -> Column:
    """What a Latin token is: a brand, a technical form, a model, else an ordinary word."""
    return F.when(F.array_contains(brands, token), "BRAND_TOKEN").when(token.rlike(TECHNICAL), "TECH_TOKEN").when(token.rlike(MODEL), "MODEL_TOKEN").otherwise("ORDINARY_WORD")


def is_untranslated(value: Column) -> Column:
    """A text without a Chinese character that has an accented letter or a function word: a conservative check."""
    text = F.trim(F.coalesce(value, F.lit("")))
    words = r"(?iu)(?<![\p{L}\p{N}_])(?:" + "|".join(FUNCTION_WORDS) + r")(?![\p{L}\p{N}_])"
    return ~has_cjk(text) & (text.rlike("(?iu)[áéíóúüñ]") | text.rlike(words))


def digit_numbers(text: Column) -> Column:
    """Numbers in digits, with a point and without zeros at either end that say nothing; a 2D or 3D is a form and no number."""
    bare = F.regexp_replace(text, "(?i)(?<![A-Za-z0-9])[23]D(?![A-Za-z0-9])", " ")
    found = F.regexp_extract_all(bare, F.lit(r"(\d+(?:[.,]\d+)?)"), F.lit(1))
    tidy = lambda x: F.regexp_replace(F.regexp_replace(F.replace(x, F.lit(","), F.lit(".")), r"^0+(?=\d)", ""), r"(\.\d*?)0+$", "$1")
    return F.transform(found, lambda x: F.regexp_replace(tidy(x), r"\.$", ""))


def cardinal_numbers(text: Column) -> Column:
    """Small cardinals before a noun that is counted; none that is the last part of a larger number."""
    before = rf"(?:(?:{'|'.join(TENS)})\s+y\s+|(?:{'|'.join(TENS)})\s+)"
    pattern = rf"(?iu)({before})?\b({'|'.join(CARDINALS)})\s+(?:pequeñ[oa]s\s+)?(?:{'|'.join(COUNTED)})\b"
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("tens"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("word"))
    values = F.create_map(*[F.lit(x) for pair in CARDINALS.items() for x in pair])
    return F.transform(F.filter(found, lambda x: x["tens"] == ""), lambda x: F.try_element_at(values, F.lower(x["word"])))


def sign_numbers(text: Column) -> Column:
    """Chinese digits beside a connector or a unit; a digit in a word is no number."""
    digits = "".join(DIGITS)
    number = f"0-9{digits}"
    signs = CONNECTORS.replace("/", "").replace("-", r"\-")
    pattern = (
        f"(?:(?<=[{signs}{UNIT_SIGNS}])|(?<=[{number}]/))([{digits}])|([{digits}])(?=[{signs}{UNIT_SIGNS}]|/[{number}])|([{digits.replace('一', '')}])(?=种)"
    )
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.create_map(*[F.lit(x) for pair in DIGITS.items() for x in pair])
    return F.transform(found, lambda x: F.try_element_at(values, x))


def number_multiset(value: Column) -> Column:
    """All numbers of a text, sorted, with repeats, whether in digits, as counted cardinals or as Chinese digits."""
    text = F.coalesce(value, F.lit(""))
    return F.array_sort(F.concat(digit_numbers(text), cardinal_numbers(text), sign_numbers(text)))


def target_text(value: Column) -> Column:
    """A rendering in one line: plain spaces, none doubled, one sign of multiplication for two."""
    plain = F.regexp_replace(F.replace(F.coalesce(value, F.lit("")), F.lit("\u00a0"), F.lit(" ")), r"[\t\r\n]+", " ")
    return F.trim(F.regexp_replace(F.replace(plain, F.lit("××"), F.lit("×")), " {2,}", " "))
