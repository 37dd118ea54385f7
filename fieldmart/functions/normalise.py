"""Column expressions for flags, defaults, labels and join keys."""

from __future__ import annotations

from functools import lru_cache, reduce
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data product.
UNASSIGNED_TA = "UNASSIGNED_TA"
FACE_TO_FACE = "F2F"
TEXT_NULL = "NULL"
CYCLE_LABELS = {
    "CC": "current cycle",
    "PC": "previous cycle",
    "PPC": "previous to previous cycle",
}
AFTER_COMMA = ",.*"


@lru_cache(maxsize=None)
def _single_characters_by_upper() -> dict[str, list[str]]:
    found: dict[str, list[str]] = {}
    for code in range(0x110000):
        upper = chr(code).upper()
        if upper.isascii():
            found.setdefault(upper, []).append(chr(code))
    return found


def spellings(code: str, most: int = 64) -> list[str] | None:
    """Every text whose upper case is `code`, or None when there are more than `most`."""
    by_upper = _single_characters_by_upper()
    widest = max(map(len, by_upper))
    made: list[list[str]] = [[""]]
    for end in range(1, len(code) + 1):
        here = []
        for start in range(max(0, end - widest), end):
            here += [a + b for a, b in product(made[start], by_upper.get(code[start:end], []))]
        if len(here) > most:
            return None
        made.append(here)
    return made[-1]


def beginnings(code: str, most: int = 16) -> list[str]:
    """Texts such that every text whose upper case is `code` starts with one of them: as long as
    `most` of them reach. None are known for codes beyond ASCII."""
    by_upper = _single_characters_by_upper()
    widest = max(map(len, by_upper))
    found: list[str] = []
    for end in range(1, len(code) + 1 if code.isascii() else 1):
        here = set()
        # The last character may stand for more letters than are left until `end`.
        for start in range(max(0, end - widest), end):
            for stop in range(end, min(len(code), start + widest) + 1):
                here.update(a + b for a, b in product(spellings(code[:start]) or [], by_upper.get(code[start:stop], [])))
        if len(here) > most:
            break
        found = sorted(here)
    return found


def equals_ignoring_case(column: Column, code: str) -> Column:
    """upper(column) = code. The list of spellings, or of the beginnings of a long code's spellings, is
    added: it follows from the condition, in a form that prunes Parquet row groups."""
    exact = F.upper(column) == F.lit(code)
    listed = spellings(code)
    if listed:
        return column.isin(listed) & exact
    begun = [column.startswith(text) for text in beginnings(code)]
    return reduce(Column.__or__, begun) & exact if begun else exact


def in_list_with_default(column: Column, values, default: str = UNASSIGNED_TA) -> Column:
    return F.upper(F.coalesce(column, F.lit(default))).isin(list(values))


def is_yes(column: Column) -> Column:
    return F.upper(column) == "Y"


def text_flag(column: Column) -> Column:
    """'true' -> 1, 'false' -> 0, anything else -> NULL."""
    text = F.upper(column)
    return F.when(text == "TRUE", 1).when(text == "FALSE", 0)


def interaction_type(column: Column) -> Column:
    missing = column.isNull() | (F.upper(column) == TEXT_NULL)
    return F.when(missing, FACE_TO_FACE).otherwise(column)


def promotional(product_name: Column, listed_flag: Column) -> Column:
    return F.when(product_name.isNull(), "N").otherwise(F.coalesce(listed_flag, F.lit("Y")))


def cycle_label(code: Column) -> Column:
    label = code
    for short, text in CYCLE_LABELS.items():
        label = F.when(code == short, text).otherwise(label)
    return label


def text_null() -> Column:
    """The four letters NULL, which is not the SQL NULL."""
    return F.lit(TEXT_NULL)


def place_key(column: Column) -> Column:
    return F.upper(F.trim(column))


def city_key(column: Column) -> Column:
    """The first city of a comma separated list, ready to compare with a place name."""
    return place_key(F.regexp_replace(column, AFTER_COMMA, ""))
