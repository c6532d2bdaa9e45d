"""Scans, staging views, unified and published tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chalkline.operators import pii
from chalkline.operators.analytics import row_counts
from chalkline.plans import k12, pipeline
from chalkline.plans.queries import query as sql_query
from chalkline.registry import bindings as b
from chalkline.registry.base import add, query, rounded
from chalkline.registry.model import Model
from chalkline.registry.oracle import staged, with_models
from chalkline.session import materialized, remove, remove_at_exit, scratch_path
from chalkline.sources import readers, sinks
from chalkline.sources.specs import CSV_ENTITIES, CSV_SOURCE, SEEDS, XML_ENTITIES, XML_SOURCE

# --- scans: the bound tables are written in the source format and read back ---


def _nest(paths: dict[str, str]):
    """Column of nested structs from dotted path -> source column."""
    tree: dict = {}
    for path, column in paths.items():
        *parents, leaf = path.split(".")
        node = tree
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = column

    def build(node):
        return F.struct(*[(F.col(v) if isinstance(v, str) else build(v)).alias(k) for k, v in node.items()])

    return tree, build


def as_elements(df: DataFrame, name: str) -> DataFrame:
    """Rows as XML element texts; rows of the assessment entity become one element with one item."""
    entity = XML_ENTITIES[name]
    paths = {p: c for c, p in entity.fields.items() if p and not (entity.items and c == "standard_code")}
    tree, build = _nest(paths)
    columns = build(tree)
    if entity.items:
        item = F.struct(*[F.col(c).alias(p) for c, p in entity.item_fields.items()])
        columns = F.struct(*[F.col("s")[k].alias(k) for k in tree], F.array(item).alias(entity.items))
        df = df.withColumn("s", build(tree))
    return df.select(F.to_xml(columns, {"rowTag": entity.row_tag}).alias("element"))


def xml_scan(m: Model, name: str) -> DataFrame:
    path = scratch_path(m.spark, "xml")
    as_elements(m.raw_xml[name], name).write.text(f"{path}/{XML_ENTITIES[name].file}")
    remove_at_exit(m.spark, path)
    return readers.read_xml(m.spark, path, name, b.LOADED_AT)


def camel_case(name: str) -> str:
    head, *tail = name.split("_")
    return head + "".join(t.capitalize() for t in tail)


def csv_scan(m: Model, name: str) -> DataFrame:
    path = scratch_path(m.spark, "csv")
    rows = m.raw_csv[name]
    headed = rows.select(*[F.col(c).alias(camel_case(c)) for c in rows.columns], F.lit("active").alias("status"))
    headed.write.option("header", True).csv(f"{path}/{CSV_ENTITIES[name].file}")
    remove_at_exit(m.spark, path)
    return readers.read_csv(m.spark, path, name, b.LOADED_AT)


for _name in XML_ENTITIES:
    # The format carries no assessment date.
    _drop = "REPLACE (CAST(NULL AS VARCHAR) AS assessment_date)" if _name == "assessment_results" else ""
    add(f"xml_scan_{_name}", lambda m, n=_name: xml_scan(m, n), with_models(f"SELECT * {_drop} FROM x_{_name}"))
for _name in CSV_ENTITIES:
    add(f"csv_scan_{_name}", lambda m, n=_name: csv_scan(m, n), with_models(f"SELECT * FROM c_{_name}"))


@query(
    "xml_items_flattened",
    """SELECT 'S' || l_suppkey AS student_unique_id, 'LI' || l_orderkey AS assessment_id, q AS question_number,
              CASE WHEN q = '1' THEN 'STD-' || l_linenumber ELSE 'ITEM-' || l_returnflag END AS standard_code,
              'A' AS correct_answer, CASE WHEN q = '1' THEN l_returnflag END AS student_answer,
              '' || l_quantity AS score, CAST(NULL AS VARCHAR) AS assessment_date,
              CAST(NULL AS VARCHAR) AS misconception_indicator, 'edfi' AS _source_system,
              '2026-01-05T06:00:00' AS _loaded_at
       FROM lineitem, (VALUES ('1'), ('2')) v(q) WHERE l_tax > 0""",
)
def xml_items_flattened(m: Model) -> DataFrame:
    """Two items per assessment; the first leaves out its code, untaxed lines have no items and vanish."""
    items = F.when(
        F.col("l_tax") > 0,
        F.concat(
            F.lit("<StudentAssessmentItem><QuestionNumber> 1 </QuestionNumber><LearningStandardCode></LearningStandardCode>"),
            F.lit("<CorrectAnswer>A</CorrectAnswer><StudentAnswer>"),
            F.col("l_returnflag"),
            F.lit("</StudentAnswer></StudentAssessmentItem><StudentAssessmentItem><QuestionNumber>2</QuestionNumber>"),
            F.lit("<LearningStandardCode>ITEM-"),
            F.col("l_returnflag"),
            F.lit("</LearningStandardCode><CorrectAnswer>\n A</CorrectAnswer></StudentAssessmentItem>"),
        ),
    ).otherwise(F.lit(""))
    element = F.format_string(
        "<StudentAssessment><AssessmentIdentifier>LI%d</AssessmentIdentifier><StudentReference><StudentUniqueId>S%d"
        "</StudentUniqueId></StudentReference><StandardCode>STD-%d</StandardCode><ScoreResult>%s</ScoreResult>%s"
        "</StudentAssessment>",
        F.col("l_orderkey"),
        F.col("l_suppkey"),
        F.col("l_linenumber"),
        F.col("l_quantity").cast("string"),
        items,
    )
    path = scratch_path(m.spark, "items")
    # compressed, as the text is some twenty times the table it is made from
    m.t["lineitem"].select(element.alias("element")).write.option("compression", "gzip").text(path)
    remove_at_exit(m.spark, path)
    entity = XML_ENTITIES["assessment_results"]
    elements = readers.xml_elements(m.spark, path, entity.row_tag)
    return readers.stamp(readers.parse_elements(elements, entity), XML_SOURCE, b.LOADED_AT)


@query(
    "xml_malformed_elements",
    """SELECT count(*) FILTER (WHERE l_discount <= 0.09) AS parsed, count(*) FILTER (WHERE l_discount > 0.09) AS malformed
       FROM lineitem""",
)
def xml_malformed_elements(m: Model) -> DataFrame:
    """Every broken element is found and none of its neighbours is lost."""
    broken = F.when(F.col("l_discount") > 0.09, F.lit("<StandardCode><Broken></StandardCode>")).otherwise(
        F.concat(F.lit("<StandardCode>"), F.col("l_orderkey"), F.lit("</StandardCode>"))
    )
    path = scratch_path(m.spark, "broken")
    m.t["lineitem"].select(F.concat(F.lit("<LearningStandard>"), broken, F.lit("</LearningStandard>"))).write.text(path)
    remove_at_exit(m.spark, path)
    entity = XML_ENTITIES["standards"]
    elements = readers.xml_elements(m.spark, path, entity.row_tag)
    good = readers.parse_elements(elements, entity).select(F.lit(1).alias("parsed"), F.lit(0).alias("malformed"))
    bad = readers.malformed_elements(elements, entity).select(F.lit(0).alias("parsed"), F.lit(1).alias("malformed"))
    return good.unionByName(bad).agg(F.sum("parsed").alias("parsed"), F.sum("malformed").alias("malformed"))


@query(
    "xml_elements_with_attributes",
    """SELECT count(*) AS elements, count(DISTINCT o_orderkey) AS codes, count(*) FILTER (WHERE o_orderstatus = 'P') AS empty,
              min(o_orderkey::varchar) AS least, max(o_orderkey::varchar) AS most, true AS by_many_tasks FROM orders""",
)
def xml_elements_with_attributes(m: Model) -> DataFrame:
    """One file of elements that all carry attributes, read by several tasks. An empty element's code is its id."""
    path = scratch_path(m.spark, "attributes")
    orders = m.t["orders"]
    content = F.when(
        F.col("o_orderstatus") == "P", F.format_string('<LearningStandard id="%d" kind="empty"/><!-- %d -->', "o_orderkey", "o_orderkey")
    ).otherwise(
        F.format_string('<LearningStandard id="%d"><StandardCode>%d</StandardCode></LearningStandard>', "o_orderkey", "o_orderkey")
    )
    orders.select(content).coalesce(1).write.text(path)
    remove_at_exit(m.spark, path)
    size = sum(f["length"] for f in m.spark.read.text(path).select("_metadata.file_path", F.col("_metadata.file_size").alias("length")).distinct().collect())
    before = m.spark.conf.get("spark.sql.files.maxPartitionBytes")
    m.spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(4096, size // 8)))
    try:
        standards = XML_ENTITIES["standards"]
        entity = replace(standards, fields=standards.fields | {"element_id": "_id"})
        elements = readers.xml_elements(m.spark, path, entity.row_tag, attributes=True)
        rows = readers.parse_elements(elements, entity)
        tasks = rows.select("standard_code", F.coalesce("standard_code", "element_id").alias("code"), F.spark_partition_id().alias("task"))
        code = F.col("code")
        out = tasks.agg(
            F.count(F.lit(1)).alias("elements"), F.count_distinct(code).alias("codes"), F.count_if(F.col("standard_code").isNull()).alias("empty"),
            F.min(code).alias("least"), F.max(code).alias("most"), (F.count_distinct("task") > 1).alias("by_many_tasks"),
        )
        return materialized(out, "attributes-read")
    finally:
        m.spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@query(
    "csv_fields_with_line_breaks",
    """SELECT 'o' || o_orderkey AS sourced_id,
              CASE WHEN o_orderkey % 3 = 0 THEN 'two' || chr(10) || '"lines" of ' || o_orderkey WHEN o_orderkey % 5 = 0 THEN 'a, b' ELSE 'plain' END AS name,
              o_orderstatus AS identifier FROM orders""",
)
def csv_fields_with_line_breaks(m: Model) -> DataFrame:
    """Quoted fields with line breaks, quotes and commas."""
    path = scratch_path(m.spark, "breaks")
    key = F.col("o_orderkey")
    name = (
        F.when(key % 3 == 0, F.concat(F.lit('two\n"lines" of '), key.cast("string"))).when(key % 5 == 0, "a, b").otherwise("plain")
    )
    rows = m.t["orders"].select(
        F.concat(F.lit("o"), key).alias("sourcedId"), name.alias("name"), F.lit("school").alias("type"), F.col("o_orderstatus").alias("identifier"), F.lit("d1").alias("parentSourcedId")
    )
    rows.write.option("header", True).option("escape", '"').csv(f"{path}/{CSV_ENTITIES['orgs'].file}")
    remove_at_exit(m.spark, path)
    return readers.read_csv(m.spark, path, "orgs", b.LOADED_AT, line_breaks=True).select("sourced_id", "name", "identifier")


def _sources(m: Model, path: str) -> None:
    """The bound tables as a delivery: XML interchange files, CSV roster and seeds, all but the seeds compressed."""
    for name, entity in XML_ENTITIES.items():
        as_elements(m.raw_xml[name], name).write.option("compression", "gzip").text(f"{path}/xml/{entity.file}")
    for name, entity in CSV_ENTITIES.items():
        rows = m.raw_csv[name]
        headed = rows.select(*[F.col(c).alias(camel_case(c)) for c in rows.columns])
        headed.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{path}/csv/{entity.file}")
    for name, rows in ((n, m.seeds[n]) for n in SEEDS):
        rows.write.option("header", True).option("escape", '"').csv(f"{path}/seeds/{name}.csv")


@query(
    "pipeline_end_to_end",
    with_models(
        " UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS rows FROM {t}""" for t in pipeline.GOLD)
        + """ UNION ALL SELECT 'students of the view', count(DISTINCT student_id) FROM dim_student JOIN dim_school USING (school_id)
              UNION ALL SELECT 'malformed', 0"""
    ),
)
def pipeline_end_to_end(m: Model) -> DataFrame:
    """The whole run from delivered files: silver, unified and published tables, and a view on two of them.

    The delivery, made here, goes as soon as it is read.
    """
    path = scratch_path(m.spark, "run")
    database = f"gold_{path.rsplit('-', 1)[-1]}"
    _sources(m, path)
    remove_at_exit(m.spark, path)

    def delivery_read() -> None:
        for source in ("xml", "csv"):
            remove(m.spark, f"{path}/{source}")

    inputs = (f"{path}/xml", f"{path}/csv", f"{path}/seeds")
    tables = pipeline.run(m.spark, *inputs, f"{path}/silver", m.as_of, m.run_ts, b.LOADED_AT, database, delivery_read)
    sinks.publish_view(k12.members(tables["dim_student"], tables["dim_school"]), f"members_{database}")
    view = sql_query(m.spark, f"SELECT 'students of the view' AS table, count(DISTINCT student_id) AS rows FROM members_{database}")
    published = row_counts({name: m.spark.table(f"{database}.{name}") for name in pipeline.GOLD})
    malformed = row_counts({"malformed": m.spark.read.parquet(f"{path}/silver/malformed")})
    return published.unionByName(view).unionByName(malformed)


@query(
    "seed_scan",
    with_models("SELECT * FROM seed_learning_standards"),
)
def seed_scan(m: Model) -> DataFrame:
    path = scratch_path(m.spark, "seed")
    m.seeds["seed_learning_standards"].write.option("header", True).csv(f"{path}/seed_learning_standards.csv")
    remove_at_exit(m.spark, path)
    return readers.read_seed(m.spark, path, "seed_learning_standards")


@query(
    "parquet_sink_overwrite",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
)
def parquet_sink_overwrite(m: Model) -> DataFrame:
    path = scratch_path(m.spark, "sink")
    rows = m.t["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    sinks.write_parquet(m.t["region"], path)
    written = sinks.write_parquet(rows, path)
    remove_at_exit(m.spark, path)
    return written


_STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(
    "registered_parquet_directories",
    " UNION ALL ".join(f"""SELECT '{t}' AS "table", count(*) AS rows FROM {t}""" for t in _STAR),
)
def registered_parquet_directories(m: Model) -> DataFrame:
    path = scratch_path(m.spark, "tables")
    sinks.write_all({name: m.t[name] for name in _STAR}, path)
    sinks.write_parquet(m.t["region"], f"{path}/_hidden")
    remove_at_exit(m.spark, path)
    return row_counts(sinks.register_parquet_dir(m.spark, path, f"registered_{path.rsplit('-', 1)[-1]}"))


@query(
    "adhoc_sql",
    """SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders
       WHERE o_totalprice > 100000 GROUP BY o_orderstatus""",
)
def adhoc_sql(m: Model) -> DataFrame:
    return sql_query(
        m.spark,
        """SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM {orders}
           WHERE o_totalprice > :floor GROUP BY o_orderstatus""",
        {"floor": 100000},
        orders=m.t["orders"],
    )


# --- staging views ------------------------------------------------------------

for _source, _entities in ((XML_SOURCE, XML_ENTITIES), (CSV_SOURCE, CSV_ENTITIES)):
    for _name in _entities:
        add(f"stg_{_source}__{_name}", lambda m, s=_source, n=_name: m.staged(s, n), with_models(staged(_source, _name)))

# --- unified and published tables ---------------------------------------------

_EXACT = (
    "int_students",
    "int_staff",
    "int_schools",
    "int_sections",
    "int_enrollments",
    "int_assessments",
    "int_grades",
    "int_attendance",
    "int_standards",
    "section_memberships",
    "dim_school",
    "dim_student",
    "dim_section",
    "dim_standard",
    "dim_misconception_pattern",
    "fact_student_mastery_daily",
    "fact_assessment_responses",
    "fact_attendance_daily",
)
for _name in _EXACT:
    add(_name, lambda m, n=_name: m.table[n], with_models(f"SELECT * FROM {_name}"))


@query(
    "fact_dq_quarantine_log",
    with_models("SELECT * REPLACE (strftime(quarantined_at, '%Y-%m-%d %H:%M:%S') AS quarantined_at) FROM fact_dq_quarantine_log"),
)
def fact_dq_quarantine_log(m: Model) -> DataFrame:
    log = m.table["fact_dq_quarantine_log"]
    return log.withColumn("quarantined_at", F.date_format("quarantined_at", "yyyy-MM-dd HH:mm:ss"))


@query(
    "agg_early_warning",
    with_models(
        """SELECT * REPLACE (round(avg_mastery_score, 9) AS avg_mastery_score, round(attendance_rate, 9) AS attendance_rate)
           FROM agg_early_warning"""
    ),
)
def agg_early_warning(m: Model) -> DataFrame:
    return rounded(m.table["agg_early_warning"], "avg_mastery_score", "attendance_rate")


@query(
    "agg_district_comparison",
    with_models(
        """SELECT * REPLACE (round(avg_score, 9) AS avg_score, round(mastery_pct, 9) AS mastery_pct)
           FROM agg_district_comparison"""
    ),
)
def agg_district_comparison(m: Model) -> DataFrame:
    return rounded(m.table["agg_district_comparison"], "avg_score", "mastery_pct")


@query(
    "district_comparison_deduplicated",
    with_models(
        """SELECT l.standard_code, t.subject, p.district_id, p.district_name, count(*) AS student_count,
                  round(avg(l.max_score_to_date), 9) AS avg_score,
                  round(avg(CASE WHEN l.mastery_level IN ('Meeting', 'Exceeding') THEN 1.0 ELSE 0.0 END), 9) AS mastery_pct
           FROM latest l JOIN (SELECT DISTINCT student_id, district_id, district_name FROM members) p USING (student_id)
           LEFT JOIN dim_standard t USING (standard_code) GROUP BY ALL"""
    ),
)
def district_comparison_deduplicated(m: Model) -> DataFrame:
    out = k12.agg_district_comparison(
        m.table["scores"],
        m.table["dim_student"],
        m.table["dim_school"],
        m.table["dim_standard"],
        dedupe=True,
    )
    return rounded(out, "avg_score", "mastery_pct")


# --- personal data --------------------------------------------------------------


@query(
    "hash_pii_columns",
    """SELECT s_suppkey, sha256(s_name) AS s_name_hash, sha256(CAST(s_nationkey AS VARCHAR)) AS email_hash,
              CASE WHEN s_acctbal > 0 THEN 2005 + s_nationkey END AS birth_year FROM supplier""",
)
def hash_pii_columns(m: Model) -> DataFrame:
    born = F.when(F.col("s_acctbal") > 0, F.concat(F.col("s_nationkey") + 2005, F.lit("-05-17"))).otherwise(F.lit("n/a"))
    rows = m.t["supplier"].select("s_suppkey", "s_name", F.col("s_nationkey").alias("mail"), born.alias("born"))
    return pii.hash_pii_columns(rows, ["s_name"], "mail", "born")


_SHAPES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "birth_date": r"(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}",
    "phone": r"[0-9]{3}-[0-9]{3}-[0-9]{4}",
}


@query(
    "pii_inventory",
    " UNION ALL ".join(
        f"""SELECT '{column}' AS column_name, '{shape}' AS shape,
                   count(*) FILTER (WHERE regexp_matches({column}, '{pattern}')) AS hits, false AS forbidden_name FROM documents"""
        for column in ("text", "lang", "source")
        for shape, pattern in _SHAPES.items()
    ),
)
def pii_inventory(m: Model) -> DataFrame:
    return pii.pii_inventory(m.t["documents"], _SHAPES)


@query(
    "masked_students_without_raw_columns",
    with_models(
        """SELECT 'student_unique_id' AS column_name, count(student_id) AS filled FROM m_students
           UNION ALL SELECT 'birth_year', count(birth_year) FROM m_students
           UNION ALL SELECT 'email_hash', count(email_hash) FROM m_students
           UNION ALL SELECT 'first_name_hash', count(first_name_hash) FROM m_students
           UNION ALL SELECT 'last_name_hash', count(last_name_hash) FROM m_students"""
    ),
)
def masked_students_without_raw_columns(m: Model) -> DataFrame:
    """What is left of the students after masking, column by column."""
    masked = pipeline.masked_students(m.raw_xml["students"])
    counts = masked.agg(*[F.count(c).alias(c) for c in masked.columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in masked.columns]
    return counts.select(F.inline(F.array(*cells)))
