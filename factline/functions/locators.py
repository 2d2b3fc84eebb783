"""Rules for the JSON locator of an evidence row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A whole number, as opposed to a boolean, text or a number written with a fraction or
# exponent. Numbers too long for 64 bits arrive as wide decimals without a fraction.
WHOLE = r"^(BIGINT|DECIMAL\((19|2\d|3\d),0\))$"
NUMBER = r"^(BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL\(.*)$"


# Locators that need no parsing: empty, or one row or page number from 1.
PLAIN = r'^\{(?:"(?:row|page)":[1-9][0-9]{0,17})?\}$'


def plain_page(locator: Column) -> Column:
    """The page number of a plain locator; null when it has none."""
    return F.nullif(F.regexp_extract(locator, r'^\{"page":([0-9]+)\}$', 1), F.lit("")).cast("decimal(38,0)")


def part(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "variant")


def kind(document: Column, path: str) -> Column:
    """The type name at a path; null when the key is absent."""
    return F.schema_of_variant(part(document, path))


def whole_number(document: Column, path: str) -> Column:
    return F.when(
        kind(document, path).rlike(WHOLE), F.try_variant_get(document, path, "decimal(38,0)")
    )


def sound_box(document: Column, path: str) -> Column:
    """Four ordered numbers between 0 and 1."""
    sides = [F.when(kind(document, f"{path}[{i}]").rlike(NUMBER),
                    F.try_variant_get(document, f"{path}[{i}]", "double")) for i in range(4)]
    four = kind(document, path).startswith("ARRAY<") & part(document, f"{path}[4]").isNull()
    for side in sides:
        four = four & side.between(0, 1)
    return F.coalesce(four & (sides[0] <= sides[2]) & (sides[1] <= sides[3]), F.lit(False))


def locator_problem(document: Column) -> Column:
    """Name the first rule a locator breaks; null when it breaks none.

    `document` is the locator as `try_parse_json` gives it.
    """

    def bad_count(path):
        return part(document, path).isNotNull() & ~F.coalesce(whole_number(document, path) >= 1, F.lit(False))

    start, end = whole_number(document, "$.start_ms"), whole_number(document, "$.end_ms")
    timed = part(document, "$.start_ms").isNotNull() | part(document, "$.end_ms").isNotNull()
    in_order = F.coalesce((start >= 0) & (start <= end), F.lit(False))
    return (
        F.when(document.isNull(), "locator is not JSON")
        .when(~F.schema_of_variant(document).startswith("OBJECT<"), "locator is not an object")
        .when(bad_count("$.page"), "page is not a number from 1")
        .when(bad_count("$.row"), "row is not a number from 1")
        .when(part(document, "$.bbox").isNotNull() & ~sound_box(document, "$.bbox"), "bbox is not normalized")
        .when(timed & ~in_order, "time range is not ordered")
    )
