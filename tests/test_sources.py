from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

import k12_files
from chalkline import session
from chalkline.sources import readers, sinks
from chalkline.sources.specs import CSV_ENTITIES, XML_ENTITIES


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    return k12_files.write(tmp_path_factory.mktemp("k12"))


LOADED = "2026-01-05T06:00:00"


def test_students_text_rules(spark, folders, rows):
    """Trimmed text, empty to NULL, blank to '', missing child NULL, entities decoded, attributes ignored."""
    df = readers.read_xml(spark, folders[0], "students", LOADED)
    assert rows(df) == [
        ("S1", "Ann", "Lee", "2015-03-14", "ann@example.com", "edfi", LOADED),
        ("S3", "Cy & Co", "Wu", "2014-07-22", "cy@example.com", "edfi", LOADED),
        (None, "Bob", "", "soon", None, "edfi", LOADED),
    ]


@pytest.mark.parametrize("name", XML_ENTITIES)
def test_every_xml_entity_has_its_columns(spark, folders, name):
    df = readers.read_xml(spark, folders[0], name, LOADED)
    assert df.columns == [*XML_ENTITIES[name].output, "_source_system", "_loaded_at"]
    assert set(dict(df.dtypes).values()) == {"string"}
    assert {r._source_system for r in df.collect()} == {"edfi"}


def test_nested_references(spark, folders, rows):
    df = readers.read_xml(spark, folders[0], "sections")
    assert rows(df, "section_identifier", "school_id", "course_name", "curriculum_version", "term_name") == [
        ("SEC-1", "SCH-1", "Kindergarten Math", "A", None),
        ("SEC-2", "SCH-1", "ELA 3", None, None),
    ]


def test_assessment_items(spark, folders, rows):
    """Items become rows, a blank item code falls back, assessments without items vanish, broken ones are set aside."""
    df = readers.read_xml(spark, folders[0], "assessment_results")
    got = rows(df, "assessment_id", "question_number", "standard_code", "student_answer", "score", "assessment_date")
    assert got == [
        ("A1", "1", "STD-1", "4", "72.5", None),
        ("A1", "2", "STD-2", "3", "72.5", None),
        ("A2", "1", "STD-1", "5", "40", None),
        ("A4", "1", "STD-1", None, "n/a", None),
        ("A5", "1", "STD-1", "4", "49.9", None),
        ("A7", "1", "STD-2", "8", "20", None),
    ]
    broken = readers.read_malformed_xml(spark, folders[0], "assessment_results").collect()
    assert len(broken) == 1 and "A6" in broken[0][0]


def test_elements_without_content_are_kept(spark, tmp_path, rows):
    text = """<LearningStandard/><LearningStandard id="1 a"/>
      <LearningStandard id="2"><StandardCode>A</StandardCode></LearningStandard>
      <LearningStandardSet/><LearningStandard
        kind="x"><StandardCode>B</StandardCode><StandardDescription/></LearningStandard><LearningStandard />"""
    (tmp_path / "LearningStandards.xml").write_text(k12_files.interchange("X", text))
    df = readers.read_xml(spark, str(tmp_path), "standards")
    assert rows(df, "standard_code", "standard_description") == [("A", None), ("B", None), (None, None), (None, None), (None, None)]


def test_one_large_xml_file_is_read_by_many_tasks(spark, tmp_path):
    body = "".join(
        f"<LearningStandard><StandardCode>C{i}</StandardCode><StandardDescription>{'d' * 50}</StandardDescription></LearningStandard>\n"
        for i in range(5000)
    )
    (tmp_path / "LearningStandards.xml").write_text(k12_files.interchange("X", body))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = readers.read_xml(spark, str(tmp_path), "standards")
        assert df.rdd.getNumPartitions() > 4
        assert df.select("standard_code").distinct().count() == 5000 == df.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("name", CSV_ENTITIES)
def test_every_csv_entity_has_its_columns(spark, folders, name):
    df = readers.read_csv(spark, folders[1], name, LOADED)
    assert df.columns == [*CSV_ENTITIES[name].columns, "_source_system", "_loaded_at"]
    assert df.count() == len(k12_files.CSV[CSV_ENTITIES[name].file][1])
    assert {r._source_system for r in df.collect()} == {"oneroster"}


def test_csv_quotes_and_blanks(spark, folders, rows):
    df = readers.read_csv(spark, folders[1], "classes")
    assert rows(df, "sourced_id", "title", "term_sourced_ids") == [("c1", "Math, period 1", "t1,t2"), ("c2", "Art", None)]


def test_csv_columns_are_found_by_name(spark, tmp_path, rows):
    (tmp_path / "orgs.csv").write_text("type,name,sourcedId,parentSourcedId,identifier\nschool,Hill,o1,d1,7\n")
    assert rows(readers.read_csv(spark, str(tmp_path), "orgs"), "sourced_id", "name", "type") == [("o1", "Hill", "school")]


def test_missing_csv_column_is_an_error(spark, tmp_path):
    (tmp_path / "orgs.csv").write_text("sourcedId,name\no1,Hill\n")
    with pytest.raises(AnalysisException):
        readers.read_csv(spark, str(tmp_path), "orgs")


def test_snake_case():
    assert readers.snake_case("demographicRaceTwoOrMoreRaces") == "demographic_race_two_or_more_races"
    assert readers.snake_case("question_number") == "question_number"


def test_seeds_are_typed(spark, folders, rows):
    seeds = readers.read_seeds(spark, folders[2])
    assert dict(seeds["seed_school_registry"].dtypes)["grade_band_low"] == "int"
    assert rows(seeds["seed_learning_standards"], "standard_code", "standard_description", "prerequisite_standard_code") == [
        ("STD-1", "Count, by ones", None),
        ("STD-2", "Add", "STD-1"),
    ]


def test_register_parquet_directories(spark, tmp_path, rows):
    root = str(tmp_path / "silver")
    sinks.write_parquet(spark.createDataFrame([(1, "alice")], "id int, name string"), f"{root}/test_table")
    sinks.write_parquet(spark.range(3), f"{root}/other")
    sinks.write_parquet(spark.range(3), f"{root}/_hidden")
    (tmp_path / "silver" / "notes.txt").write_text("not a table")
    tables = sinks.register_parquet_dir(spark, root, "custom_schema")
    assert sorted(tables) == ["other", "test_table"]
    assert rows(spark.table("custom_schema.test_table")) == [(1, "alice")]
    sinks.write_parquet(spark.createDataFrame([(2, "bob")], "id int, name string"), f"{root}/test_table")
    sinks.register_parquet_dir(spark, root, "custom_schema")
    assert rows(spark.table("custom_schema.test_table")) == [(2, "bob")]
    spark.sql("DROP DATABASE custom_schema CASCADE")


def test_string_schema():
    schema = readers.string_schema(["a", "b"])
    assert schema.simpleString() == "struct<a:string,b:string>" and all(f.nullable for f in schema)


CODE = "<LearningStandard><StandardCode>{}</StandardCode></LearningStandard>"


@pytest.mark.parametrize(
    ("text", "good", "broken"),
    [
        ("<A>" + CODE.format(1) + "<LearningStandard><StandardCode>2</StandardCode><Grade>3</Grade>", ["1"], 1),
        ("<A>" + CODE.format(1) + "<LearningStandard>", ["1"], 0),
        ("<A><LearningStandard><StandardCode>1</StandardCode>" + CODE.format(2) + "</A>", ["2"], 1),
        ("<?xml version='1.0'?><A>" + CODE.format(1) + "</LearningStandard>" + CODE.format(2) + "</A>", ["1", "2"], 0),
        ("<A><!-- none here -->\n" + CODE.format(1) + "<!-- between -->" + CODE.format(2) + "</A>", ["1", "2"], 0),
        ("<A>" + CODE.format("<![CDATA[1</LearningStandard>]]>") + CODE.format(2) + "</A>", ["1</LearningStandard>", "2"], 0),
        ("<A>" + CODE.format("<![CDATA[<LearningStandard>]]>") + CODE.format(2) + "</A>", ["2"], 2),
        ("<A>" + CODE.format(1) + CODE.format(2).replace("Standard>", "Standard id='x'>", 1) + CODE.format(3) + "</A>", ["1", "2", "3"], 0),
        ("<A><LearningStandard/>" + CODE.format(1) + "<LearningStandard id='3'/></A>", [None, "1", None], 0),
        ("", [], 0),
    ],
)
def test_elements_are_those_of_the_file(spark, tmp_path, text, good, broken):
    (tmp_path / "LearningStandards.xml").write_text(text)
    codes = [r.standard_code for r in readers.read_xml(spark, str(tmp_path), "standards").collect()]
    assert sorted(codes, key=str) == sorted(good, key=str)
    assert readers.read_malformed_xml(spark, str(tmp_path), "standards").count() == broken


def test_commented_elements_are_refused(spark, tmp_path):
    (tmp_path / "LearningStandards.xml").write_text("<A>" + CODE.format(1) + "<!-- " + CODE.format(2) + " --></A>")
    with pytest.raises(Exception, match="a comment holds <LearningStandard> elements"):
        readers.read_xml(spark, str(tmp_path), "standards").collect()


def csv_parts(folder, *parts):
    """One CSV entity as a folder of part files."""
    path = folder / CSV_ENTITIES["orgs"].file
    path.mkdir()
    for k, text in enumerate(parts):
        (path / f"part-{k}.csv").write_text(text)


ORGS = "sourcedId,name,type,identifier,parentSourcedId"


def test_csv_part_files_agree_in_their_header(spark, tmp_path):
    csv_parts(tmp_path, f"{ORGS}\nO1,One,school,1,D\n", f"{ORGS}\nO2,Two,school,2,D\n")
    assert sorted(r.name for r in readers.read_csv(spark, str(tmp_path), "orgs").collect()) == ["One", "Two"]


def test_csv_part_with_another_header_order_is_an_error(spark, tmp_path):
    csv_parts(tmp_path, f"{ORGS}\nO1,One,school,1,D\n", "name,sourcedId,type,identifier,parentSourcedId\nTwo,O2,school,2,D\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv(spark, str(tmp_path), "orgs").collect()


def test_torn_csv_rows_are_listed(spark, tmp_path):
    csv_parts(tmp_path, f'{ORGS}\nO1,"One\nmore",school,1,D\nO2,Two,school,2,D\nO3,Three,school,3,D,extra\n')
    assert "Two" in [r.name for r in readers.read_csv(spark, str(tmp_path), "orgs").collect()]
    torn = readers.read_malformed_csv(spark, str(tmp_path), "orgs")
    assert torn.count() == 3
    assert sorted(r.element[:2] for r in torn.collect()) == ["O1", "O3", "mo"]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    for n in names:
        spark.conf.set(n, "2000" if n.endswith("PartitionBytes") else "100")
    yield
    for n, v in zip(names, old, strict=True):
        spark.conf.set(n, v)


def roster(names):
    quoted = ['"' + n.replace('"', '""') + '"' if any(c in n for c in ',"\n') else n for n in names]
    return "sourcedId,name,type,identifier,parentSourcedId\n" + "".join(f"o{i},{q},school,{i},d\n" for i, q in enumerate(quoted))


def test_csv_fields_may_hold_line_breaks(spark, tmp_path, small_splits):
    names = [("Hill\n\"north\"\n\nend, of it" if i % 7 == 0 else "a, b" if i % 5 == 0 else "x") + str(i) for i in range(1200)]
    (tmp_path / "orgs.csv").mkdir()
    (tmp_path / "orgs.csv" / "a.csv").write_text(roster(names))
    (tmp_path / "orgs.csv" / "b.csv").write_text(roster(["plain"] * 50))  # has no breaks, so is read as it is
    df = readers.read_csv(spark, str(tmp_path), "orgs", line_breaks=True)
    assert sorted(r["name"] for r in df.collect()) == sorted(names + ["plain"] * 50)
    assert len({p for p, in spark.read.text(str(tmp_path / "orgs.csv")).selectExpr("spark_partition_id()").distinct().collect()}) > 5
    assert readers.read_malformed_csv(spark, str(tmp_path), "orgs", line_breaks=True).count() == 0


def test_csv_quote_that_is_never_closed(spark, tmp_path, monkeypatch, small_splits):
    monkeypatch.setattr(readers, "MOST_LINES", 20)
    lines = roster(["x"] * 300).splitlines()
    lines[100] = 'o99,"torn,school,99,d'
    (tmp_path / "orgs.csv").write_text("\n".join(lines) + "\n")
    df = readers.read_csv(spark, str(tmp_path), "orgs", line_breaks=True)
    ids = {r.sourced_id for r in df.collect()}
    assert {f"o{i}" for i in range(300)} - ids <= {"o99"}
    assert readers.read_malformed_csv(spark, str(tmp_path), "orgs", line_breaks=True).count() == 1


def test_headers_of_files_with_line_breaks_are_checked(spark, tmp_path):
    (tmp_path / "orgs.csv").mkdir()
    (tmp_path / "orgs.csv" / "a.csv").write_text(roster(["x"]))
    (tmp_path / "orgs.csv" / "b.csv").write_text(roster(["y\ny"]).replace("sourcedId,name", "name,sourcedId"))
    with pytest.raises(Exception, match="header"):
        readers.read_csv(spark, str(tmp_path), "orgs", line_breaks=True).collect()


def test_elements_with_attributes_are_read_by_many_tasks(spark, tmp_path, small_splits):
    body = "".join(
        f'<LearningStandard id="{i}"><StandardCode>C{i}</StandardCode></LearningStandard>\n'
        + ('<LearningStandard id="e"/><LearningStandard/>' if i % 9 == 0 else "")
        + ("<LearningStandard>\n<StandardCode>P</StandardCode></LearningStandard>" if i % 13 == 0 else "")
        + ("<LearningStandard\nk='1'><StandardCode>N</StandardCode></LearningStandard>" if i % 19 == 0 else "")
        for i in range(600)
    )
    whole = k12_files.interchange("X", body)
    for text in (whole, whole[:20_000], "<X><LearningStandard a='1'><StandardCode>u<LearningStandard b='2'><StandardCode>v</StandardCode></LearningStandard></X>"):
        (tmp_path / "LearningStandards.xml").write_text(text)
        plain, split = (readers.read_xml(spark, str(tmp_path), "standards", attributes=a) for a in (False, True))
        codes = [sorted(str(r.standard_code) for r in df.collect()) for df in (plain, split)]
        assert codes[0] == codes[1]
    (tmp_path / "LearningStandards.xml").write_text(whole)
    filled = [n for n in readers.read_xml(spark, str(tmp_path), "standards", attributes=True).rdd.glom().map(len).collect() if n]
    assert len(filled) > 10


def test_a_failed_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_parquet(spark.range(5), path)
    broken = spark.range(100).selectExpr("CASE WHEN id = 77 THEN raise_error('half way') ELSE id END AS id").repartition(4)
    with pytest.raises(Exception, match="half way"):
        sinks.write_parquet(broken, path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_write_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    once = sinks.write_parquet(spark.range(5), path)
    twice = sinks.write_parquet(once.union(once), path)
    assert twice.count() == 10
    assert sinks.publish(spark.range(3), "swapped", "swap_test").count() == 3
    assert sinks.publish(spark.table("swap_test.swapped").union(spark.range(4)), "swapped", "swap_test").count() == 7
    spark.sql("DROP DATABASE swap_test CASCADE")


def test_buckets_only_where_no_value_is_hot(spark, monkeypatch):
    rows = spark.range(1000).selectExpr("if(id < 400, 7, id) AS k", "id AS v")
    spread = sinks.publish(rows, "spread", "bucket_test", by="k", buckets=4)
    assert spread.count() == 1000
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED bucket_test.spread").collect()}
    assert described["Num Buckets"] == "4" and described["Bucket Columns"] == "[`k`]"
    monkeypatch.setattr(sinks, "HOT_BUCKET_ROWS", 399)
    hot = sinks.publish(spark.table("bucket_test.spread"), "spread", "bucket_test", by="k", buckets=4)
    described = {r.col_name for r in spark.sql("DESCRIBE EXTENDED bucket_test.spread").collect()}
    assert "Num Buckets" not in described
    assert sorted(hot.collect()) == sorted(rows.collect())
    assert sinks.publish(rows.limit(0), "none", "bucket_test", by="k").count() == 0
    assert {r.tableName for r in spark.sql("SHOW TABLES IN bucket_test").collect()} == {"spread", "none"}
    spark.sql("DROP DATABASE bucket_test CASCADE")


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f.name for folder in folders for f in Path(folder).rglob("shuffle_*.data")}


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    setting = spark.conf.get(session._DROP, None)
    counted = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    for write in (lambda: sinks.write_parquet(counted, str(tmp_path / "counted")), lambda: sinks.publish(counted, "counted", "shuffle_test")):
        before = shuffle_files(spark)
        write()
        assert not shuffle_files(spark) - before
    assert spark.conf.get(session._DROP, None) == setting
