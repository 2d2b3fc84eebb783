"""Stored results that a person reads page by page."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factline.functions.canonical import canonical_row
from factline.operators.numbering import PART_BITS, part_of, place, position_of, with_place
from factline.storage import fresh_path

# Paging limits and the bytes of a response kept for its envelope.
LARGEST_PAGE = 100
ENVELOPE_BYTES = 2_048


def unique_names(df: DataFrame) -> DataFrame:
    """Give a repeated column name its position as a suffix, and keep doing so until all differ."""
    names: list[str] = []
    for position, name in enumerate(df.columns):
        while name in names:
            name = f"{name}_{position}"
        names.append(name)
    return df.toDF(*names)


@dataclass(frozen=True)
class StoredResult:
    """A result written once; every row keeps its place, so a page is a range of one or few files."""

    spark: SparkSession
    path: str
    schema: T.StructType

    def _placed(self) -> DataFrame:
        return self.spark.read.schema(with_place(self.schema)).parquet(f"{self.path}/rows")

    def _parts(self) -> DataFrame:
        """First row number of each written partition; one row per partition."""
        return self.spark.read.parquet(f"{self.path}/parts")

    def table(self) -> DataFrame:
        return self._placed().drop("_at")

    def total_rows(self) -> int:
        return self._parts().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def page(self, offset: int = 0, limit: int = 20) -> DataFrame:
        """Rows `offset` to `offset + limit - 1` with their number in `_row`."""
        if not (isinstance(offset, int) and offset >= 0 and isinstance(limit, int) and 1 <= limit <= LARGEST_PAGE):
            raise ValueError("offset must be at least 0 and limit between 1 and 100")
        # Each selected partition holds at least one of the page's rows: at most `limit` of them.
        touched = self._parts().filter((F.col("first") < offset + limit) & (F.col("first") + F.col("rows") > offset)).collect()
        at = F.col("_at")
        wanted, number = F.lit(False), F.lit(None).cast("bigint")
        for row in touched:
            base = row["part"] << PART_BITS
            low = base + max(offset - row["first"], 0)
            high = base + min(offset + limit - row["first"], row["rows"]) - 1
            wanted = wanted | at.between(low, high)
            number = F.when(at.between(low, high), at - base + row["first"]).otherwise(number)
        return self._placed().filter(wanted).select(*self.schema.fieldNames(), number.alias("_row"))

    def read(self, offset: int = 0, limit: int = 20, response_bytes: int = 65_536) -> dict:
        """A page as rows for a person, within a byte budget; an oversized first row leaves a marker."""
        page = self.page(offset, limit)
        names = T.StructType([f for f in page.schema.fields if f.name != "_row"])
        texts = page.select("_row", canonical_row(names).alias("text"))
        upto = F.sum(F.octet_length("text") + 1).over(Window.orderBy("_row"))
        budget = response_bytes - ENVELOPE_BYTES
        fits = texts.withColumn("_upto", upto).filter(F.col("_upto") <= budget).orderBy("_row").collect()
        total = self.total_rows()
        rows = [json.loads(r["text"]) for r in fits]
        if not rows and offset < total:
            rows = [{"_oversized_row": offset, "full_result": self.path}]
        after = offset + len(rows)
        return {"rows": rows, "next_offset": after if after < total else None,
                "truncated": after < total or any("_oversized_row" in r for r in rows),
                "total_rows": total, "full_result": self.path}


def store_result(df: DataFrame, order: list[str] | None = None, path: str | None = None) -> StoredResult:
    """Write a result with the place of every row. Give `order` unless the plan already sorts."""
    spark = df.sparkSession
    named = unique_names(df)
    path = path or fresh_path(spark, "result")
    place(named, order, f"{path}/rows")
    result = StoredResult(spark, path, named.schema)
    sizes = result._placed().groupBy(part_of(F.col("_at")).alias("part")).agg(
        F.max(position_of(F.col("_at")) + 1).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first")).coalesce(1).write.parquet(
        f"{path}/parts")
    return result


def preview(df: DataFrame, rows: int = 5) -> dict:
    """Schema and first rows. The row count is unknown, not zero, because nothing was counted."""
    return {"schema": [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields],
            "row_count": None, "preview": [r.asDict(recursive=True) for r in df.take(rows)]}


def rows_for_person(df: DataFrame, most: int = 100_000) -> list[dict]:
    """All rows of a small result; a longer one is refused, not cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"result has more than {most} rows; aggregate or page it")
    return [r.asDict(recursive=True) for r in rows]
