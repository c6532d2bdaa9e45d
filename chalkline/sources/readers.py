"""Distributed scans of the XML interchange files, the CSV roster and the seeds."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chalkline.sources.specs import (
    CSV_ENTITIES,
    CSV_SOURCE,
    SEEDS,
    XML_ENTITIES,
    XML_SOURCE,
    CsvEntity,
    XmlEntity,
)

MALFORMED = "_malformed"


def string_schema(columns) -> T.StructType:
    """All columns nullable strings."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def stamp(df: DataFrame, source: str, loaded_at: str | None = None) -> DataFrame:
    """Add ``_source_system`` and the load time as ISO text."""
    loaded_at = loaded_at or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    return df.withColumns({"_source_system": F.lit(source), "_loaded_at": F.lit(loaded_at)})


# --- XML --------------------------------------------------------------------


def _nested(paths) -> T.StructType:
    """String fields at the given dotted paths, as nested structs."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = None

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [T.StructField(n, T.StringType() if sub is None else build(sub), True) for n, sub in node.items()]
        )

    return build(tree)


def xml_schema(entity: XmlEntity) -> T.StructType:
    schema = _nested([p for p in entity.fields.values() if p])
    if entity.items:
        schema = schema.add(entity.items, T.ArrayType(_nested(entity.item_fields.values())))
    return schema.add(MALFORMED, T.StringType())


def xml_text(value: Column) -> Column:
    """Element text: empty is NULL, everything else is trimmed (blank text becomes '')."""
    return F.btrim(F.nullif(value, F.lit("")), F.lit(" \t\n\r\x0b\x0c"))


def xml_elements(spark: SparkSession, path: str, row_tag: str, column: str = "element", attributes: bool = False) -> DataFrame:
    """One row per ``row_tag`` element, as text.

    The text reader splits at the opening tag, so one large file is read by many tasks and every piece shows whether its
    element is closed: one that is not, as it is cut off or lacks its closing tag, comes out unclosed and does not parse,
    and those behind it are not touched.  An element goes to the last closing tag of its piece, so a closing tag in a
    CDATA section does not end it; an opening tag there makes two broken elements.  Comments that hold an element are
    refused by an error.  What lies before the first element is the file's frame.

    The text is split at ``<row_tag>``, or with ``attributes`` at ``<row_tag`` and a blank, which suits files whose
    elements carry attributes.  Elements of the other kind are cut out of the pieces, so either way gives the same rows
    from any file; the one that suits it lets more tasks share a large file.
    """
    opening, closing, tag = f"<{row_tag} " if attributes else f"<{row_tag}>", f"</{row_tag}>", re.escape(row_tag)
    pieces = spark.read.text(path, lineSep=opening)
    other = rf"(?=<{tag}(\s[^<>]*)?(?<!/)>)" if attributes else rf"(?=<{tag}\s[^<>]*(?<!/)>)"
    parts = pieces.select(F.posexplode(F.split("value", other, -1)).alias("__at", "__part"))
    part = F.col("__part")
    text = F.when(F.col("__at") == 0, F.concat(F.lit(opening), part)).otherwise(part)
    closed = part.contains(closing)
    behind = F.when(closed, F.substring_index(part, closing, -1)).otherwise(part)
    if attributes:  # the opening tag may turn out to close itself
        alone = (F.col("__at") == 0) & part.rlike(r"^[^<>]*/>")
        behind = F.when(alone, F.substr(part, F.instr(part, "/>") + 2)).otherwise(behind)
        closed = closed | alone
    bare = F.regexp_replace(part, rf"(?s)<!--.*?-->|<{tag}(\s[^<>]*)?/>", "")
    frame = ~closed & (F.col("__at") == 0) & bare.rlike(r"^\x{FEFF}?\s*(<[?!]|(<[^<>/!?][^<>]*(?<!/)>\s*)?\z)")
    open_comment = (closed | frame) & behind.contains("<!--") & ~F.substring_index(behind, "<!--", -1).contains("-->")
    refused = F.raise_error(F.lit(f"a comment holds <{row_tag}> elements"))
    element = (
        F.when(open_comment, refused.cast("string"))
        .when(closed, F.substring(text, F.lit(1), F.length(text) - F.length(behind)))
        .when(~frame, text)
    )
    empty = F.when(closed | frame, F.regexp_extract_all(behind, F.lit(rf"<{tag}(\s[^<>]*)?/>"), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )
    return parts.select(F.explode(F.array_compact(F.array_append(empty, element))).alias(column))


def parse_elements(elements: DataFrame, entity: XmlEntity, column: str = "element", keep=()) -> DataFrame:
    """Flat rows from element texts; ``keep`` names other columns to carry along.

    Broken elements give no rows here, see ``malformed_elements``.
    """
    parsed = _parsed(elements, entity, column, keep).filter(F.col(MALFORMED).isNull())
    if entity.items:
        parsed = parsed.withColumn("__item", F.explode(entity.items))
    out = []
    for name in entity.output:
        values = []
        if name in entity.item_fields:
            values.append(F.col(f"__item.{entity.item_fields[name]}"))
        if entity.fields.get(name):
            values.append(F.col(entity.fields[name]))
        texts = [xml_text(v) for v in values]
        if len(texts) > 1:  # a blank child falls back to its parent, too
            texts = [F.nullif(texts[0], F.lit("")), *texts[1:]]
        out.append((F.coalesce(*texts) if texts else F.lit(None).cast("string")).alias(name))
    return parsed.select(*[F.col(f"__keep_{k}").alias(k) for k in keep], *out)


def malformed_elements(elements: DataFrame, entity: XmlEntity, column: str = "element") -> DataFrame:
    """Texts of the elements that cannot be parsed."""
    return _parsed(elements, entity, column).select(F.col(MALFORMED).alias(column)).filter(F.col(column).isNotNull())


def _parsed(elements: DataFrame, entity: XmlEntity, column: str, keep=()) -> DataFrame:
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": MALFORMED,
        "ignoreSurroundingSpaces": "false",
    }
    # A generator is a border for the optimizer: without it, every filter above would parse the text again.
    parsed = F.inline(F.array(F.from_xml(F.col(column), xml_schema(entity), options)))
    return elements.select(*[F.col(k).alias(f"__keep_{k}") for k in keep], parsed)


def read_xml(spark: SparkSession, directory: str, name: str, loaded_at: str | None = None, attributes: bool = False) -> DataFrame:
    """One XML entity as flat string columns with provenance; ``attributes`` as for ``xml_elements``."""
    entity = XML_ENTITIES[name]
    elements = xml_elements(spark, f"{directory}/{entity.file}", entity.row_tag, attributes=attributes)
    return stamp(parse_elements(elements, entity), XML_SOURCE, loaded_at)


def read_malformed_xml(spark: SparkSession, directory: str, name: str) -> DataFrame:
    entity = XML_ENTITIES[name]
    return malformed_elements(xml_elements(spark, f"{directory}/{entity.file}", entity.row_tag), entity)


# --- CSV --------------------------------------------------------------------


def snake_case(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def select_entity(rows: DataFrame, entity: CsvEntity) -> DataFrame:
    """Header names to snake case, then the entity's columns; a missing column is an error."""
    renamed = rows.select(*[F.col(f"`{c}`").alias(snake_case(c)) for c in rows.columns])
    return renamed.select(*entity.columns)


# A record of more lines than this is taken for a quote that is never closed.
MOST_LINES = 10_000

_LINE = ["__file", "__block"]


def _csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of CSV files with their file, block and place in the block, and how many quotes they hold."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("__quotes"),
    )


def csv_records(lines: DataFrame) -> DataFrame:
    """``__file``, ``__record`` (from 1) and ``value``: records whose quoted fields may hold line breaks.

    A line begins a record if an even number of quotes lies before it in its file.  Every block is scanned on its own,
    without knowing whether it begins within quotes; then its number of quotes and of beginnings, one row for each block,
    tell how many lie before each, and so which of its lines begin a record and with what number.  Lines of one record
    are put together again, also over the border of blocks; records of one line are not shuffled again.  The breaks
    come back as \\n.  A record of more than ``MOST_LINES`` lines stays apart as single lines.
    """
    within = Window.partitionBy(*_LINE).orderBy("__at")
    before = F.coalesce(F.sum("__quotes").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    scanned = lines.withColumn("__before", before)
    blocks = scanned.groupBy(*_LINE).agg(
        F.sum("__quotes").alias("q"), F.count_if(F.col("__before") % 2 == 0).alias("even"), F.count_if(F.col("__before") % 2 == 1).alias("odd")
    )
    along = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.withColumn("__carry", F.coalesce(F.sum("q").over(along), F.lit(0)) % 2)
    carried = carried.withColumn("begun", F.when(F.col("__carry") == 0, F.col("even")).otherwise(F.col("odd")))
    carried = carried.select(*_LINE, "__carry", F.coalesce(F.sum("begun").over(along), F.lit(0)).alias("__begun"))
    inside = (F.col("__before") + F.col("__carry")) % 2 == 1
    placed = scanned.join(carried, _LINE).withColumn("__inside", inside)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("__record", F.col("__begun") + F.sum(F.when(F.col("__inside"), 0).otherwise(1)).over(upto))
    whole = ~F.col("__inside") & (F.col("__quotes") % 2 == 0)
    parts = placed.filter(~whole)
    sizes = parts.groupBy("__file", "__record").agg(F.count("*").alias("__lines"))
    torn = parts.join(sizes, ["__file", "__record"])
    put = F.transform(F.array_sort(F.collect_list(F.struct("__block", "__at", "value"))), lambda line: line["value"])
    joined = torn.filter(F.col("__lines") <= MOST_LINES).groupBy("__file", "__record").agg(F.array_join(put, "\n").alias("value"))
    columns = ["__file", "__record", "value"]
    return placed.filter(whole).select(*columns).unionByName(joined).unionByName(torn.filter(F.col("__lines") > MOST_LINES).select(*columns))


def _csv_rows(spark: SparkSession, path: str, line_breaks: bool) -> DataFrame:
    """All columns as strings under the names of the header, and what is wrong with a row in ``MALFORMED``.

    The first file's header names the columns; another file whose header differs, in order too, is an error.  With
    ``line_breaks``, files in which some line holds an odd number of quotes have their records put together first
    (``csv_records``).  Which they are is found in the plan, and adaptive execution drops that branch if there are none.
    """
    header = spark.read.option("header", True).option("escape", '"').csv(path).columns
    schema = string_schema([*header, MALFORMED])
    reader = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False)
    rows = reader.option("columnNameOfCorruptRecord", MALFORMED).schema(schema).csv(path)
    if not line_breaks:
        return rows
    lines = _csv_lines(spark, path)
    # a row for each file at most, and the driver lists all files anyway
    broken = F.broadcast(lines.filter(F.col("__quotes") % 2 == 1).select(F.col("__file").alias("__broken")).distinct())
    usual = rows.withColumn("__file", F.col("_metadata.file_path")).join(broken, F.col("__file") == F.col("__broken"), "left_anti")
    records = csv_records(lines.join(broken, F.col("__file") == F.col("__broken"), "left_semi"))
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    names = F.from_csv("value", string_schema([f"_{k}" for k in range(len(header))]).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"escape": '"'})
    same = F.array(*(F.coalesce(F.regexp_replace(names[f"_{k}"], r"^\x{FEFF}", ""), F.lit("")) for k in range(len(header)))) == F.array(*map(F.lit, header))
    refused = F.raise_error(F.lit("the header of a file differs")).cast("boolean")
    body = records.filter(F.when(F.col("__record") > 1, F.lit(True)).when(same, F.lit(False)).otherwise(refused))
    ddl = ", ".join(f"`{c}` string" for c in [*header, MALFORMED])
    # a generator is a border for the optimizer, which would have every field parse the record again
    parsed = body.select(F.inline(F.array(F.from_csv("value", ddl, options))))
    return usual.select(*rows.columns).unionByName(parsed)


def read_csv(spark: SparkSession, directory: str, name: str, loaded_at: str | None = None, line_breaks: bool = False) -> DataFrame:
    """One CSV entity: all strings, columns found by header name, empty fields NULL.

    With ``line_breaks`` quoted fields may hold some, at the price of a look through all lines first; without, they tear
    a record into rows.  Rows with too few or too many fields stay, as far as they go; ``read_malformed_csv`` lists them.
    """
    entity = CSV_ENTITIES[name]
    return stamp(select_entity(_csv_rows(spark, f"{directory}/{entity.file}", line_breaks), entity), CSV_SOURCE, loaded_at)


def read_malformed_csv(spark: SparkSession, directory: str, name: str, line_breaks: bool = False) -> DataFrame:
    """Lines of one CSV entity with too few or too many fields, as ``element``."""
    rows = _csv_rows(spark, f"{directory}/{CSV_ENTITIES[name].file}", line_breaks)
    # the parser counts the fields of a line only if all are asked for, so the filter names them all
    any_field = F.length(F.concat_ws("", *(F.col(f"`{c}`") for c in rows.columns if c != MALFORMED))) >= 0
    return rows.where(F.col(MALFORMED).isNotNull() & any_field).select(F.col(MALFORMED).alias("element"))


def read_seed(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A seed table with its declared types."""
    return spark.read.option("header", True).option("escape", '"').schema(SEEDS[name]).csv(f"{directory}/{name}.csv")


def read_seeds(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {name: read_seed(spark, directory, name) for name in SEEDS}


# --- all entities -----------------------------------------------------------


def read_all_xml(spark: SparkSession, directory: str, loaded_at: str | None = None) -> dict[str, DataFrame]:
    return {name: read_xml(spark, directory, name, loaded_at) for name in XML_ENTITIES}


def read_all_csv(spark: SparkSession, directory: str, loaded_at: str | None = None) -> dict[str, DataFrame]:
    return {name: read_csv(spark, directory, name, loaded_at, line_breaks=True) for name in CSV_ENTITIES}
