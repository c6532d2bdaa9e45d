"""Files in, published tables out."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chalkline.functions.exprs import hashed
from chalkline.operators import quality
from chalkline.operators.analytics import row_counts
from chalkline.operators.joins import lookup
from chalkline.operators.pii import hash_pii_columns
from chalkline.plans import k12
from chalkline.plans.staging import stage
from chalkline.session import build_session
from chalkline.sources import readers, sinks
from chalkline.sources.specs import CSV_ENTITIES, CSV_SOURCE, XML_ENTITIES, XML_SOURCE

Frames = dict[str, DataFrame]

# The published tables.
GOLD = (
    "dim_student",
    "dim_school",
    "dim_standard",
    "dim_section",
    "dim_misconception_pattern",
    "fact_student_mastery_daily",
    "fact_assessment_responses",
    "fact_attendance_daily",
    "fact_dq_quarantine_log",
    "agg_early_warning",
    "agg_district_comparison",
)

# Those with a student_id, by which they are joined and grouped.
BY_STUDENT = ("dim_student", "fact_student_mastery_daily", "fact_assessment_responses", "fact_attendance_daily", "agg_early_warning")


def masked_students(raw: DataFrame) -> DataFrame:
    return hash_pii_columns(raw, ["first_name", "last_name"], "email", "birth_date")


def masked_users(raw: DataFrame, demographics: DataFrame | None) -> DataFrame:
    """Users carry no birth date of their own; it comes from the demographics file."""
    if demographics is not None:
        raw = lookup(raw, demographics, "sourced_id", ["birth_date"])
    return hash_pii_columns(raw, ["given_name", "family_name"], "email", "birth_date")


def xml_silver(spark: SparkSession, directory: str, loaded_at: str | None = None) -> Frames:
    tables = readers.read_all_xml(spark, directory, loaded_at)
    return tables | {"students": masked_students(tables["students"])}


def csv_silver(spark: SparkSession, directory: str, loaded_at: str | None = None) -> Frames:
    tables = readers.read_all_csv(spark, directory, loaded_at)
    return tables | {"users": masked_users(tables["users"], tables.get("demographics"))}


def malformed_log(spark: SparkSession, xml_input: str | None, csv_input: str | None, run_ts: datetime | Column) -> DataFrame:
    """Broken XML elements and CSV lines as log rows.

    The text may hold personal data, so the log shows its hash.
    """
    xml_rule = quality.Rule(
        "malformed_xml", "Element is not well-formed XML", "element", "Must be well-formed", F.lit(True), shown=hashed("element")
    )
    csv_rule = quality.Rule(
        "malformed_csv", "Line has too few or too many fields", "line", "Must have a field for each column", F.lit(True),
        shown=hashed("element"),
    )
    broken = []
    if xml_input is not None:
        broken += [(XML_SOURCE, name, xml_rule, readers.read_malformed_xml(spark, xml_input, name)) for name in XML_ENTITIES]
    if csv_input is not None:
        broken += [(CSV_SOURCE, name, csv_rule, readers.read_malformed_csv(spark, csv_input, name, line_breaks=True)) for name in CSV_ENTITIES]
    logs = []
    for source, name, rule, rows in broken:
        named = rows.withColumns({"_source_system": F.lit(source), "__id": F.lit(None).cast("string")})
        logs.append(quality.violations(named, [replace(rule, entity=name)], run_ts, "__id"))
    return quality.union_logs(logs)


def bronze_to_silver(
    spark: SparkSession,
    xml_input: str | None,
    csv_input: str | None,
    parquet_output: str,
    loaded_at: str | None = None,
    register: bool = False,
    run_ts: datetime | Column | None = None,
) -> dict[str, Frames]:
    """Parse, mask, write.  A source given as None is skipped.

    Broken XML elements and CSV lines are logged below ``parquet_output``/malformed.

    Personal data is masked before the first write, so no raw copy of the
    students or users table ever reaches the output folder.
    """
    out: dict[str, Frames] = {}
    if xml_input is not None:
        out[XML_SOURCE] = sinks.write_all(xml_silver(spark, xml_input, loaded_at), f"{parquet_output}/{XML_SOURCE}")
    if csv_input is not None:
        out[CSV_SOURCE] = sinks.write_all(csv_silver(spark, csv_input, loaded_at), f"{parquet_output}/{CSV_SOURCE}")
    if out:
        logged = malformed_log(spark, xml_input, csv_input, F.current_timestamp() if run_ts is None else run_ts)
        sinks.write_parquet(logged, f"{parquet_output}/malformed")
    if register:
        for source in out:
            out[source] = sinks.register_parquet_dir(spark, f"{parquet_output}/{source}", f"silver_{source}")
    return out


def silver_to_gold(
    silver: dict[str, Frames],
    seeds: Frames,
    as_of: Column,
    run_ts: datetime | Column,
    save=lambda name, df: df,
) -> Frames:
    """All unified and published tables.

    ``save`` is called with every published table and returns the frame to go on
    with: writing there cuts the plan, so the mastery fact is computed once.
    """
    xml, csv = stage(XML_SOURCE, silver[XML_SOURCE]), stage(CSV_SOURCE, silver[CSV_SOURCE])
    t = k12.unified(xml, csv, seeds)
    registry = seeds["seed_school_registry"]
    t["dim_school"] = save("dim_school", k12.dim_school(t["int_schools"], registry))
    t["dim_student"] = save("dim_student", k12.dim_student(t["int_students"], t["int_enrollments"]))
    t["dim_standard"] = save("dim_standard", k12.dim_standard(t["int_standards"]))
    t["dim_section"] = save("dim_section", k12.dim_section(t["int_sections"]))
    t["dim_misconception_pattern"] = save(
        "dim_misconception_pattern", k12.dim_misconception_pattern(seeds["seed_misconception_patterns"])
    )
    t["fact_student_mastery_daily"] = save(
        "fact_student_mastery_daily", k12.fact_student_mastery_daily(t["int_assessments"])
    )
    t["fact_assessment_responses"] = save(
        "fact_assessment_responses",
        k12.fact_assessment_responses(t["int_assessments"], t["dim_misconception_pattern"]),
    )
    t["fact_attendance_daily"] = save("fact_attendance_daily", k12.fact_attendance_daily(t["int_attendance"]))
    t["fact_dq_quarantine_log"] = save(
        "fact_dq_quarantine_log",
        k12.fact_dq_quarantine_log(t["int_enrollments"], t["int_students"], t["dim_school"], as_of, run_ts),
    )
    t["agg_early_warning"] = save(
        "agg_early_warning", k12.agg_early_warning(t["fact_student_mastery_daily"], t["fact_attendance_daily"])
    )
    t["agg_district_comparison"] = save(
        "agg_district_comparison",
        k12.agg_district_comparison(
            t["fact_student_mastery_daily"], t["dim_student"], t["dim_school"], t["dim_standard"]
        ),
    )
    return t | {f"{XML_SOURCE}.{n}": df for n, df in xml.items()} | {f"{CSV_SOURCE}.{n}": df for n, df in csv.items()}


def run(
    spark: SparkSession,
    xml_input: str,
    csv_input: str,
    seed_dir: str,
    parquet_output: str,
    as_of: Column,
    run_ts: datetime | Column,
    loaded_at: str | None = None,
    database: str | None = None,
    silver_written: Callable[[], None] | None = None,
) -> Frames:
    """Bronze to gold.  Published tables go to ``database``, or below ``parquet_output`` when none is named.

    In a database, the tables of ``BY_STUDENT`` are bucketed by student, so that they are joined without an exchange.
    ``silver_written`` is called when the XML and CSV input has been read for the last time.
    """
    silver = bronze_to_silver(spark, xml_input, csv_input, parquet_output, loaded_at, run_ts=run_ts)
    if silver_written is not None:
        silver_written()
    seeds = readers.read_seeds(spark, seed_dir)

    def save(name: str, df: DataFrame) -> DataFrame:
        if database is None:
            return sinks.write_parquet(df, f"{parquet_output}/gold/{name}")
        return sinks.publish(df, name, database, by="student_id" if name in BY_STUDENT else None)

    return silver_to_gold(silver, seeds, as_of, run_ts, save)


def main(argv: list[str] | None = None) -> None:
    """Command line: ``python -m chalkline.plans.pipeline --out DIR [--xml DIR] [--csv DIR] [--seeds DIR] …``.

    Without seeds the run stops at silver; a source that is not named is skipped.
    """
    parser = argparse.ArgumentParser(description="Read, mask, unify and publish the K-12 tables.")
    parser.add_argument("--xml", help="folder of the XML interchange files")
    parser.add_argument("--csv", help="folder of the CSV roster files")
    parser.add_argument("--seeds", help="folder of the three reference CSVs")
    parser.add_argument("--out", required=True, help="folder for the Parquet tables")
    parser.add_argument("--database", help="catalog database for the published tables")
    parser.add_argument("--as-of", help="day that counts as today (YYYY-MM-DD)")
    args = parser.parse_args(argv)
    spark = build_session("chalkline-pipeline")
    as_of = F.lit(args.as_of).cast("date") if args.as_of else F.current_date()
    if not args.seeds:
        written = bronze_to_silver(spark, args.xml, args.csv, args.out, register=args.database is not None)
        counts = {f"{source}.{name}": df for source, tables in written.items() for name, df in tables.items()}
    elif args.xml and args.csv:
        tables = run(spark, args.xml, args.csv, args.seeds, args.out, as_of, F.current_timestamp(), database=args.database)
        counts = {name: tables[name] for name in GOLD}
    else:
        parser.error("publishing needs both --xml and --csv")
    row_counts(counts).orderBy("table").show(100, truncate=False)


if __name__ == "__main__":
    main()
