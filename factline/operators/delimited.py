"""CSV text to records, with one file cut over many tasks.

A quoted field may hold line ends, so where a record ends depends on every quote before it. Each
line is taken as a function of the state it starts in (inside or outside quotes) to the state it
ends in; such functions compose, so a block of lines is one function too. Blocks are summed up
where they lie, the state at the start of each block follows from one row a block, and lines then
know their state and record number without a task having seen the file before them.

The rules are those of the usual dialect: comma, double quotes, a doubled quote inside quotes;
a quote only opens at the start of a field, and text after a closing quote is taken literally.
Blank lines outside quotes are no records. The first record names the fields.

Short texts without quotes need none of this: each of their lines is a record, and is read where it lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factline.functions import text
from factline.functions.once import once
from factline.storage import keep

#: Lines that make one block at most; a task holds the flags of one block at a time.
BLOCK_LINES = 50_000
#: Bytes of a text without quotes that is read where it lies; the lines of a longer one go over tasks.
PLAIN_BYTES = 1 << 20

_INNER = r'(?:[^"]++|"")*+'
_FIELDS = rf'(?:(?:"{_INNER}"[^,]*+|[^",][^,]*+|),)*+'
#: A line from outside quotes that ends inside them.
OPENS = rf'\A{_FIELDS}"{_INNER}\z'
#: A line from inside quotes that ends inside them: the quotes stay open, or others do later.
STAYS = rf'\A{_INNER}(?:"[^,]*+,{_FIELDS}"{_INNER})?+\z'
FIELD = rf',("{_INNER}"?+[^,]*+|[^,]*+)'
#: What JSON escapes, quotes and newlines aside.
_ESCAPED = r"[\x00-\x09\x0b-\x1f\\]"


def lines_of_text(documents: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Lines `(asset_id, block, at, line)` of `(asset_id, markdown)` texts whose line ends are newlines."""
    split = documents.select("asset_id", F.posexplode(F.split("markdown", "\n")).alias("at", "line"))
    return split.select("asset_id", F.floor(F.col("at") / block_lines).cast("bigint").alias("block"), F.col("at").cast("bigint").alias("at"), "line")


def carried(df: DataFrame, group: list[str], order: str) -> DataFrame:
    """Add `before0` and `before1`: the state at a row if its group starts outside or inside quotes.

    A row maps outside to `from0` and inside to `from1`. The state is what the last row that maps
    both to one set it to, changed by every row since that swaps the two.
    """
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum((F.col("from0") & ~F.col("from1")).cast("bigint")).over(earlier), F.lit(0)) % 2 == 1
    swapped = df.withColumn("_swapped", swaps)
    fixed = F.last(F.when(F.col("from0") == F.col("from1"), F.col("from0") != F.col("_swapped")), ignorenulls=True).over(earlier)
    placed = swapped.withColumn("_fixed", fixed)
    return placed.select(*df.columns, *[
        (F.coalesce("_fixed", F.lit(inside)) != F.col("_swapped")).alias(f"before{int(inside)}") for inside in (False, True)])


def _after(inside: str) -> Column:
    return F.when(F.col(f"before{inside}"), F.col("from1")).otherwise(F.col("from0"))


def _placed_lines(lines: DataFrame) -> DataFrame:
    """Lines with their states and running counts of records, for either state that their block may start in."""
    quoted = F.contains("line", F.lit('"'))
    known = once(lines, from0=quoted & F.col("line").rlike(OPENS), from1=~quoted | F.col("line").rlike(STAYS))
    placed = carried(known, ["asset_id", "block"], "at")
    sofar = Window.partitionBy("asset_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select("*", *[
        F.sum((~F.col(f"before{i}") & (F.col("line") != "")).cast("bigint")).over(sofar).alias(f"n{i}") for i in "01"])


def _blocks(placed: DataFrame) -> DataFrame:
    """For each block the state it starts in and the records begun before it."""
    # The last line's states as the two low bits behind its place: one number, which Spark combines without a sort.
    last = F.col("at") * 4 + _after("0").cast("bigint") * 2 + _after("1").cast("bigint")
    ends = placed.groupBy("asset_id", "block").agg(F.max(last).alias("_last"), F.max("n0").alias("n0"), F.max("n1").alias("n1"))
    known = carried(ends.select(
        "asset_id", "block", (F.col("_last").bitwiseAND(F.lit(2)) != 0).alias("from0"), (F.col("_last").bitwiseAND(F.lit(1)) != 0).alias("from1"),
        "n0", "n1"), ["asset_id"], "block")
    earlier = Window.partitionBy("asset_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("before0"), F.col("n1")).otherwise(F.col("n0"))
    return known.select("asset_id", "block", F.col("before0").alias("inside"), F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("begun"))


def raw_records(lines: DataFrame) -> DataFrame:
    """Records `(asset_id, number, record)` of lines `(asset_id, block, at, line)`, numbered from 1 in each asset.

    Lines are dealt out by block once and stored with what they are for either state of their
    block; then a row for each block tells which of both holds. Records of one line stay where
    they are, others are put together by number. A quote that never closes makes the rest of
    its file one record.
    """
    # Stored: a file read anew may be cut elsewhere.
    placed = keep(_placed_lines(lines), "csv-lines")
    # Stored: one row a block.
    blocks = keep(_blocks(placed), "csv-blocks")
    met = placed.join(blocks, ["asset_id", "block"])
    inside = F.col("inside")
    state = met.select(
        "asset_id", "block", "at", "line", F.when(inside, F.col("before1")).otherwise(F.col("before0")).alias("before"),
        F.when(inside, _after("1")).otherwise(_after("0")).alias("after"),
        (F.col("begun") + F.when(inside, F.col("n1")).otherwise(F.col("n0"))).alias("number"))
    whole = state.filter(~F.col("before") & ~F.col("after") & (F.col("line") != "")).select("asset_id", "number", F.col("line").alias("record"))
    parts = state.filter(F.col("before") | F.col("after")).groupBy("asset_id", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "line"))).alias("parts"))
    return whole.unionByName(parts.select("asset_id", "number", F.array_join("parts.line", "\n").alias("record")))


def fields(record: Column) -> Column:
    """The fields of a record, unquoted."""

    def plain(field: Column) -> Column:
        inner = F.regexp_extract(field, rf'\A"({_INNER})', 1)
        rest = F.substring(field, F.length(inner) + 3, F.length(field))
        return F.when(field.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)).otherwise(field)

    found = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(FIELD), 1)
    return F.when(F.contains(record, F.lit('"')), F.transform(found, plain)).otherwise(F.split(record, ","))


def _places(names: Column) -> Column:
    """Each name once, as it stands in the quote, with the place of the last field of that name."""
    return F.transform(F.array_distinct(names), lambda name: F.struct(
        F.concat(text.json_string(name), F.lit(": ")).alias("name"),
        (F.size(names) - F.array_position(F.reverse(names), name)).cast("int").alias("place")))


def _quote(places: Column, width: Column, values: Column) -> Column:
    """The record as a JSON object with blanks after separators; a name that recurs keeps its last value.

    Fields beyond the header, of `width` names, stand as a list under `null`; those that are missing are null.
    """
    pairs = F.transform(places, lambda x: F.concat(x["name"], F.coalesce(text.json_string(F.get(values, x["place"])), F.lit("null"))))
    beyond = F.slice(values, width + 1, F.greatest(F.size(values) - width, F.lit(0)))
    listed = F.concat(F.lit('"null": ['), F.array_join(F.transform(beyond, text.json_string), ", "), F.lit("]"))
    whole = F.when(F.size(values) > width, F.concat(pairs, F.array(listed))).otherwise(pairs)
    return F.concat(F.lit("{"), F.array_join(whole, ", "), F.lit("}"))


def _heads(first: DataFrame, names: Column) -> DataFrame:
    """What names alone tell, found once a file, not once a record: their number, and the places of those asked for."""
    named = once(first, _names=names)
    last = {f"_{name}": F.size("_names") - F.array_position(F.reverse("_names"), name) for name in ("item", "value", "category")}
    return named.select(*first.columns, F.size("_names").alias("_width"), _places(F.col("_names")).alias("_places"), *[
        F.when(F.array_contains("_names", name[1:]), place).cast("int").alias(name) for name, place in last.items()])


def _published(split: DataFrame, quote: Column) -> DataFrame:
    """Evidence and observation columns of records `(_asset, number, _values)` with the places of their names."""

    def named(name: str) -> Column:
        return F.get("_values", F.col(f"_{name}"))

    return split.select(
        F.col("_asset").alias("asset_id"), F.col("number").cast("string").alias("key"),
        F.concat(F.lit('{"row":'), F.col("number").cast("string"), F.lit("}")).alias("locator_json"),
        quote.alias("quote"), named("item").alias("item"), text.float_or_null(named("value")).alias("value"),
        text.blank_to_null(named("category")).alias("category"))


def csv_records(lines: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Records of CSV lines as evidence and observation columns, keyed by record number from 2.

    `assets` maps the `asset_id` of the lines, such as a path, to the one to publish: `(path, asset_id)`.
    """
    raw = keep(raw_records(lines), "csv-records")
    first = raw.filter("number = 1").select(F.col("asset_id").alias("_of"), "record")
    heads = _heads(first, fields(text.strip_bom(F.col("record")))).drop("record")
    if assets is not None:
        known = assets.select(F.col("path").alias("_path"), F.col("asset_id").alias("_asset"))
        heads = heads.join(known, F.col("_of") == F.col("_path")).select(*heads.columns, "_asset")
    else:
        heads = heads.withColumn("_asset", F.col("_of"))
    # One row a file: Spark deals records anew only where these are many.
    met = raw.filter("number > 1").join(keep(heads, "csv-heads"), F.col("asset_id") == F.col("_of"))
    split = once(met.select("_asset", "number", "_width", "_places", "_item", "_value", "_category", "record"), _values=fields(F.col("record")))
    return _published(split, _quote(F.col("_places"), F.col("_width"), F.col("_values")))


def is_plain(body: Column) -> Column:
    """Whether a text is short and without quotes."""
    return F.coalesce((F.octet_length(body) <= PLAIN_BYTES) & ~F.contains(body, F.lit('"')), F.lit(False))


def plain_records(documents: DataFrame) -> DataFrame:
    """Records of `(asset_id, markdown)` texts that are plain: those of `csv_records`, without a shuffle or a stored table.

    No quote opens, so lines have no states: the number of a record is its place among the lines
    that are not blank, and the names lie in the row of the text.
    """
    cut = once(documents.filter(F.col("asset_id").isNotNull()).select(F.col("asset_id").alias("_asset"), "markdown"),
               _lines=F.array_remove(F.split("markdown", "\n"), ""))
    named = once(cut.filter(F.size("_lines") > 1), _first=F.split(text.strip_bom(F.get("_lines", F.lit(0))), ","))
    # The usual record has a value for each name, once, and nothing that JSON escapes: names and values alternate.
    usual = (F.size(F.array_distinct("_first")) == F.size("_first")) & ~F.col("markdown").rlike(_ESCAPED)
    openings = F.when(usual, F.transform("_first", lambda name: F.concat(F.lit('"'), name, F.lit('": "'))))
    heads = _heads(named.select("_asset", "_lines", "_first", openings.alias("_openings")), F.col("_first"))
    each = heads.select(
        "_asset", "_width", "_places", "_item", "_value", "_category", "_openings", F.posexplode("_lines").alias("_at", "_line")).filter("_at > 0")
    split = once(each.withColumn("number", F.col("_at") + 1), _values=F.split("_line", ","))
    pairs = F.array_join(F.zip_with("_openings", "_values", lambda opening, value: F.concat(opening, value)), '", ')
    quote = F.when(F.col("_openings").isNotNull() & (F.size("_values") == F.col("_width")), F.concat(F.lit("{"), pairs, F.lit('"}'))).otherwise(
        _quote(F.col("_places"), F.col("_width"), F.col("_values")))
    return _published(split, quote)
