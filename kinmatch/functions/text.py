"""Text clean-up, pack-size extraction and Python-style printing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns of the pack-size, SKU and clean-up rules.
QUANTITY_PATTERN = r"(isi(?: |)\d+|x(?: |)\d+|\d+(?: |)(?:pcs|pc|kaleng|sachet|pack|(?: |)x)) "
CARTON_PATTERN = r"\d+(?: |)(?:karton|dus)"
MILLILITRE_PATTERN = r"\d{2,}(?: |)ml "
LITRE_PATTERN = r"\d+(?: |)(?:l|lt|ltr|liter) "
GRAM_PATTERN = r"\d{2,}(?: |)(?:g|gr|gram) "
KILOGRAM_PATTERN = r"\d+(?: |)(?:|kg|kilogram|kilo) "
KILOGRAM_STRICT_PATTERN = r"\d+(?: |)(?:kg|kilogram|kilo) "
SKU_PATTERN = r"(\d){4}/(\d){19}/(\d){2}"
CARTON_QUANTITY = 12
DEFAULT_QUANTITY = 1

# Unicode whitespace and word characters, spelled out so that every regex engine agrees.
SPACE_CLASS = r"\t-\r\x1c-\x1f \x{85}\p{Z}"
ESCAPE_PATTERN = r"\\[^\n]"
NON_WORD_PATTERN = rf"[^\p{{L}}\p{{N}}_{SPACE_CLASS}]"
OUTER_SPACE_PATTERN = rf"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _match(text: Column | str, pattern: str) -> Column:
    """First match of the whole pattern, NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(text), f"({pattern})", 1), F.lit(""))


def first_number(text: Column | str) -> Column:
    """First run of digits as a number, NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(text), r"\d+", 0), F.lit("")).try_cast("bigint")


def name_description(name: Column | str, description: Column | str) -> Column:
    return F.lower(F.concat(_col(name), F.lit(" "), _col(description)))


def extract_quantity(text: Column | str) -> Column:
    counted, carton = _match(text, QUANTITY_PATTERN), _match(text, CARTON_PATTERN)
    return (
        F.when(counted.isNotNull(), first_number(counted))
        .when(carton.isNotNull(), F.lit(CARTON_QUANTITY))
        .otherwise(F.lit(DEFAULT_QUANTITY))
        .cast("bigint")
    )


def extract_volume(text: Column | str, litre_fix: bool = False) -> Column:
    """Millilitres. Litre matches give NULL unless ``litre_fix`` is set."""
    small = _match(text, MILLILITRE_PATTERN)
    volume = F.when(small.isNotNull(), first_number(small))
    if litre_fix:
        volume = volume.otherwise(first_number(_match(text, LITRE_PATTERN)) * 1000)
    return volume.cast("bigint")


def extract_weight(text: Column | str, strict_kg: bool = False) -> Column:
    """Grams. By default a bare number before a space counts as kilograms too."""
    small = _match(text, GRAM_PATTERN)
    large = _match(text, KILOGRAM_STRICT_PATTERN if strict_kg else KILOGRAM_PATTERN)
    return (
        F.when(small.isNotNull(), first_number(small))
        .otherwise(first_number(large) * 1000)
        .cast("bigint")
    )


def display_unit(quantity="quantity", volume="volume", weight="weight", uom="uom") -> Column:
    """``' q x'`` and ``' size uom'``, each left out when its number is 0 or NULL."""

    def number(c):
        return F.coalesce(_col(c).cast("bigint"), F.lit(0))

    def nonzero(c):
        return F.coalesce(_col(c).cast("double"), F.lit(0.0)) != 0

    unit = F.coalesce(_col(uom), F.lit("None"))
    count = F.when(nonzero(quantity), F.concat(F.lit(" "), number(quantity), F.lit(" x")))
    size = F.when(nonzero(volume), F.concat(F.lit(" "), number(volume), F.lit(" "), unit)).when(
        nonzero(weight), F.concat(F.lit(" "), number(weight), F.lit(" "), unit)
    )
    return F.concat(F.coalesce(count, F.lit("")), F.coalesce(size, F.lit("")))


def base_name(name: Column | str, unit: Column | str) -> Column:
    """The name without any copy of its display unit."""
    return F.replace(_col(name), _col(unit), F.lit(""))


def extract_sku(text: Column | str) -> Column:
    return _match(text, SKU_PATTERN)


def clean_text(text: Column | str) -> Column:
    """NULL becomes 'None'; escapes and punctuation go; trimmed and lower-cased."""
    filled = F.coalesce(_col(text), F.lit("None"))
    plain = F.regexp_replace(F.regexp_replace(filled, ESCAPE_PATTERN, ""), NON_WORD_PATTERN, "")
    return F.lower(F.regexp_replace(plain, OUTER_SPACE_PATTERN, ""))


def normalize_filename(filename: Column | str) -> Column:
    """Keep ``stem.jpg``; anything else becomes the text before its first dot plus ``.jpg``."""
    f = _col(filename)
    return F.when(f.rlike(r"^[^.]*\.jpg$"), f).otherwise(
        F.concat(F.substring_index(f, ".", 1), F.lit(".jpg"))
    )


def url_basename(url: Column | str) -> Column:
    return F.element_at(F.split(_col(url), "/"), -1)


def _float_text(number: Column) -> Column:
    """A double printed in Python's style, from Spark's scientific notation."""
    plain = number.cast("double").cast("string")
    parts = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign, lead, tail = (F.regexp_extract(plain, parts, i) for i in (1, 2, 3))
    exponent = F.nullif(F.regexp_extract(plain, parts, 4), F.lit("")).try_cast("int")
    digits = F.when(tail == "0", F.lit("")).otherwise(tail)
    whole = F.concat(lead, F.rpad(F.substring(digits, F.lit(1), exponent), exponent, F.lit("0")))
    rest = F.substring(digits, exponent + 1, F.lit(20))
    shifted = F.concat(sign, whole, F.lit("."), F.when(rest == "", F.lit("0")).otherwise(rest))
    small = F.concat(sign, F.lit("0.000"), lead, digits)
    mantissa = F.concat(sign, lead, F.when(digits == "", "").otherwise(F.concat(F.lit("."), digits)))
    scale = F.concat(
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.when(F.abs(exponent) < 10, F.concat(F.lit("0"), F.abs(exponent))).otherwise(
            F.abs(exponent).cast("string")
        ),
    )
    return (
        F.when(F.isnan(number.cast("double")), F.lit("nan"))
        .when(plain == "Infinity", F.lit("inf"))
        .when(plain == "-Infinity", F.lit("-inf"))
        .when(exponent.isNull(), plain)
        .when(exponent.between(7, 15), shifted)
        .when(exponent == -4, small)
        .otherwise(F.concat(mantissa, scale))
    )


def python_text(column: Column | str, data_type: T.DataType) -> Column:
    """The value as Python's ``str`` prints it, missing values as ``nan``."""
    c = _col(column)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = _float_text(c)
    elif isinstance(data_type, T.BooleanType):
        text = F.initcap(c.cast("string"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("nan"))
