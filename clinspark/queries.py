"""Every operator as a query over the supplied tables.

Roles: customer = patients, orders = encounters, lineitem = their events, part / events / nation /
region = coded tables, supplier = providers, conversations = notes.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinspark.functions.columns import (
    cast_codes, drop_descriptions, lower_columns, rename_back, rename_columns,
)
from clinspark.functions.dates import parse_dates, parse_instant, parse_strict_date
from clinspark.operators import audit
from clinspark.operators.codes import (
    CODE_BRANCHES, LONGEST_RULE, CodeBranch, build_codes, code_pairs, lookup_descriptions, one_description,
)
from clinspark.operators.concepts import EventSource, event_union, map_concepts
from clinspark.operators.dedup import distinct_rows, first_per_key
from clinspark.operators.providers import fan_out, filter_by_number, urgent_care
from clinspark.operators.relink import (
    add_first_encounter, delete_orphans, drop_null_encounter, first_encounter_of_each_row,
    first_encounters, orphans, reassign_orphans,
)
from clinspark.operators.surrogate import KeyStore, surrogate_keys
from clinspark.operators.trim import history_window, launch_trim
from clinspark.operators.visit_store import VisitStore
from clinspark.operators.visits import (
    assign_visits, number_visits, roll_up_visits, visit_cells, visit_of_encounter,
)
from clinspark.operators.vocabulary import concept_targets
from clinspark.plans.codes import denormalize, normalize
from clinspark.plans.load import load_table
from clinspark.plans.omop import omop_convert, person_table
from clinspark.plans.providers import curate_lists
from clinspark.sources.csv_tables import read_table
from clinspark.sources.notes import (
    NOTE_END, PATIENT_FOLDER_PATTERN, patient_of_file, read_notes, segment_notes, write_notes,
)
from clinspark.sources.curve import cluster_by_curve
from clinspark.sources.sinks import append_new, append_table, cluster_table, replace_table, write_csv
from clinspark.sources.vocab import load_vocabulary
from clinspark.spec import TableSpec, select_tables
from clinspark.staging import Staging

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
LAUNCH = dt.date(1998, 1, 1)

CODE_SOURCES = {
    "SNOMED": (
        CodeBranch("SNOMED", "part", "p_brand", "p_name"),
        CodeBranch("SNOMED", "part", "p_type", "p_name"),
        CodeBranch("SNOMED", "nation", "n_nationkey", "n_name"),
        CodeBranch("SNOMED", "region", "r_regionkey", "r_name"),
    ),
    "RxNorm": (CodeBranch("RxNorm", "events", "event_type", "props"),),
    "CVX": (CodeBranch("CVX", "events", "event_type", "props"),),
    "LOINC": (CodeBranch("LOINC", "part", "p_brand", "p_name", LONGEST_RULE),),
    "DICOM-DCM": (CodeBranch("DICOM-DCM", "part", "p_brand", "p_type"),),
    "DICOM-SOP": (CodeBranch("DICOM-SOP", "part", "p_type", "p_name"),),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in names or TABLES}


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All encounters; start and stop are the order date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("patient"),
        F.col("o_orderdate").alias("start"),
        F.col("o_orderdate").alias("stop"),
        F.col("o_orderstatus").alias("class"),
    )


def trimmed_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return launch_trim(encounters(spark, sf_dir), "stop", LAUNCH)


def child_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems as a child table: the encounter, which every seventh has lost, and the patient of the untrimmed encounter."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    owner = encounters(spark, sf_dir).select(F.col("id").alias("_id"), "patient")
    known = F.when(F.col("l_partkey") % 7 != 0, F.col("l_orderkey"))
    found = lines.withColumn("encounter", known).join(owner, F.col("l_orderkey") == F.col("_id"), "left")
    return found.select(*lines.columns, "encounter", "patient")


# ---- sources and sinks


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark).path("orders.csv")
    source = table(spark, sf_dir, "orders")
    write_csv(source.toDF(*[c.upper() for c in source.columns]), path)
    return read_table(spark, path, TableSpec("orders", ("o_orderdate",))).rows


def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and separators, through CSV files."""
    path = Staging(spark).path("documents.csv")
    source = table(spark, sf_dir, "documents").select("doc_id", "source", "text", "lang")
    source.write.options(
        header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    spec = TableSpec("documents", types=(("doc_id", "bigint"), ("source", "string"), ("text", "string"), ("lang", "string")))
    return read_table(spark, path, spec, quoted_breaks=True).rows


def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.table_counts(tables(spark, sf_dir))


def manifest_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = audit.table_counts(tables(spark, sf_dir))
    chosen = {
        "include": select_tables(TABLES, include=["orders.csv", "lineitem.csv"]),
        "exclude": select_tables(TABLES, exclude=["embeddings.csv"]),
        "both": select_tables(TABLES, include=["orders.csv"], exclude=["lineitem.csv"]),
        "neither": select_tables(TABLES),
    }
    picked = F.array_compact(
        F.array(*[F.when(F.col("table_name").isin(names), F.lit(how)) for how, names in chosen.items()])
    )
    return counts.select(F.explode(picked).alias("selection"), "table_name", "n_rows")


def schema_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.column_report(tables(spark, sf_dir))


def parse_dates_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("birthdate"),
    )
    return parse_dates(texts, ["start", "birthdate"])


def note_file_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.translate("c_name", "#", "_"), F.lit("_"), F.col("c_custkey"), F.lit(".txt"))
    plain = F.concat(F.lit("notes"), F.col("c_custkey"), F.lit(".txt"))
    files = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, plain).otherwise(name).alias("file_name")
    )
    return files.withColumn("patient", patient_of_file("file_name"))


def note_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rendered as a note file, one dated note per line, and taken apart again."""
    lines = F.split("text", "\n")
    note = lambda line, i: F.concat(
        F.date_add(F.lit("2020-01-01").cast("date"), i).cast("string"), F.lit("\n\n"), line, F.lit(NOTE_END)
    )
    rendered = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("patient"),
        F.concat_ws("", F.transform(lines, note)).alias("text"),
    )
    notes = segment_notes(rendered)
    return notes.select(parse_strict_date("header").alias("date"), "note_text", "patient")


def note_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as note files and read back."""
    path = Staging(spark).path("notes")
    notes = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("patient"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("turn").cast("int")).alias("date"),
        F.col("text").alias("note_text"),
    )
    write_notes(notes, path)
    return read_notes(spark, path, pattern=PATIENT_FOLDER_PATTERN, group=1, match_path=True).rows


def literal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.lit("urgent care")
    listed = urgent_care(spark).select("id", "name", "city", "zip", "type", "LAT", "LON", kind.alias("list"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("list")
    )
    return listed.unionByName(suppliers, allowMissingColumns=True)


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark).path("customer")
    source = table(spark, sf_dir, "customer")
    replace_table(source.withColumn("c_acctbal", F.lit(0.0)), path)
    replace_table(source, path)
    return spark.read.schema(source.schema).parquet(path)


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark).path("orders")
    source = table(spark, sf_dir, "orders")
    append_table(source.where(F.col("o_orderdate") < F.lit(LAUNCH).cast("timestamp_ntz")), path, run_id="before")
    append_table(source.where(F.col("o_orderdate") >= F.lit(LAUNCH).cast("timestamp_ntz")), path, run_id="after")
    return spark.read.schema(source.withColumn("run_id", F.lit("")).schema).parquet(path)


def vocab_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = Staging(spark).path("vocabulary")
    concepts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("concept_id"),
        F.col("p_name").alias("concept_name"),
        F.lit("Device").alias("domain_id"),
        F.col("p_brand").alias("vocabulary_id"),
        F.col("p_type").alias("concept_class_id"),
        F.when(F.col("p_size") > 25, F.lit("S")).alias("standard_concept"),
        F.col("p_partkey").cast("string").alias("concept_code"),
        F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.col("p_size")), "yyyyMMdd").alias("valid_start_date"),
        F.lit("20991231").alias("valid_end_date"),
        F.when(F.col("p_size") == 1, F.lit("D")).alias("invalid_reason"),
    )
    write_csv(concepts, f"{folder}/CONCEPT.csv", sep="\t")
    return load_vocabulary(spark, folder, ["concept"])["concept"]


def layout_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark).path("lineitem")
    cluster_table(spark, f"{sf_dir}/lineitem.parquet", path, ["l_shipdate"])
    return spark.read.schema(table(spark, sf_dir, "lineitem").schema).parquet(path)


def layout_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows, laid out by three columns at once; the date window is read from the files that may hold it."""
    path = Staging(spark).path("lineitem")
    cluster_by_curve(spark, f"{sf_dir}/lineitem.parquet", path, ["l_shipdate", "l_partkey", "l_orderkey"])
    stored = spark.read.schema(table(spark, sf_dir, "lineitem").schema).parquet(path)
    return stored.where(F.col("l_shipdate") >= F.lit(LAUNCH).cast("timestamp_ntz"))


def sink_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of which each repeats some rows of the one before, the second of them twice."""
    path = Staging(spark).path("orders")
    source = table(spark, sf_dir, "orders")
    third = F.col("o_orderkey") % 3
    for run, rows in (("a", third < 2), ("b", third > 0), ("b", third > 0), ("c", F.lit(True))):
        append_new(source.where(rows), path, "o_orderkey", run_id=run)
    return spark.read.schema(source.withColumn("run_id", F.lit("")).schema).parquet(path)


def load_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV is written in a known order, so that the first row of an id is known."""
    staging = Staging(spark)
    source = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("ID"),
        F.col("l_partkey").alias("CODE"),
        F.col("l_suppkey").alias("SUPPLIER"),
        F.col("l_extendedprice").alias("BASE_COST"),
        F.col("l_returnflag").alias("DESCRIPTION"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("START"),
    )
    write_csv(source.orderBy("ID", F.col("CODE"), "SUPPLIER", "BASE_COST"), staging.path("events.csv"))
    spec = TableSpec("events", ("start",), trimmed=True)
    return staging.table(load_table(spark, staging.path("events.csv"), spec, LAUNCH, stage=staging).rows)


# ---- columns and filters


def lower_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return lower_columns(part.toDF(*[c.upper() for c in part.columns]))


def launch_trim_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return launch_trim(table(spark, sf_dir, "orders"), "o_orderdate", LAUNCH)


def history_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_window(table(spark, sf_dir, "orders"), "o_orderdate", years=3)


def npi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_by_number(table(spark, sf_dir, "supplier"), [1, 4, 9, None], "s_suppkey")


def provider_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = {
        "hospice": [1], "dialysis": [1, 2], "hospitals": [1, 2],
        "primary": [3, 4, 5], "primary_children": [3, 4, 5], "primary_women": [3, 4, 5],
    }
    return fan_out(table(spark, sf_dir, "supplier"), targets, "s_suppkey")


def provider_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two source lists written as CSV, filtered to five targets, and read back."""
    staging = Staging(spark)
    suppliers, customers = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    lists = {
        "hospitals.csv": suppliers.select(
            (F.col("s_suppkey") - 1).alias("index"), F.col("s_suppkey").alias("npi"), F.col("s_name").alias("name")
        ),
        "rehab.csv": customers.select(
            (F.col("c_custkey") - 1).alias("index"), F.col("c_custkey").alias("npi"), F.col("c_name").alias("name")
        ),
    }
    for source, df in lists.items():
        write_csv(df, staging.path(f"in/{source}"))
    plan = [
        ("hospitals.csv", "hospice.csv", [1]), ("hospitals.csv", "dialysis.csv", [1, 2]),
        ("hospitals.csv", "hospitals.csv", [1, 2]), ("rehab.csv", "rehab.csv", [3, 5]),
        ("rehab.csv", "women.csv", [5]),
    ]
    curate_lists(spark, staging.path("in"), staging.path("out"), plan)
    schema = "index bigint, npi bigint, name string, target string"
    return reduce(DataFrame.unionByName, [
        spark.read.schema(schema).csv(staging.path(f"out/{source}"), header=True) for source in lists
    ])


def drop_null_encounter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_null_encounter(reassign_orphans_query(spark, sf_dir))


def rename_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"o_orderdate": "start_year", "o_orderstatus": "status"}
    return rename_back(rename_columns(table(spark, sf_dir, "orders"), names), names)


def cast_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_codes(table(spark, sf_dir, "part"), ["p_partkey", "p_size", "p_name"])


def cast_timestamptz(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("text")
    )
    return texts.select("event_id", F.unix_micros(parse_instant("text")).alias("instant_us"))


def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return audit.storage_report(
        rename_columns(lines, {"l_partkey": "code", "l_shipdate": "birthdate", "l_returnflag": "encounter"})
    )


def drop_descriptions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("code"), F.col("p_name").alias("description")
    )
    return drop_descriptions(coded, "SNOMED")


# ---- encounters


def first_encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    patients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return add_first_encounter(patients, trimmed_encounters(spark, sf_dir))


def first_value_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = trimmed_encounters(spark, sf_dir).select("id", "patient", "start")
    return first_encounter_of_each_row(visits)


def _loose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitems of which every seventh has lost its encounter; the key is not the first column."""
    lines = table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_partkey") % 7 != 0, F.col("l_orderkey")).alias("l_orderkey")
    return lines.select(*[c for c in lines.columns if c != "l_orderkey"], key)


def orphans_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans(_loose_lines(spark, sf_dir), trimmed_encounters(spark, sf_dir), key="l_orderkey")


def delete_orphans_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_orphans(_loose_lines(spark, sf_dir), trimmed_encounters(spark, sf_dir), key="l_orderkey")


def reassign_orphans_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    visits = trimmed_encounters(spark, sf_dir)
    return reassign_orphans(
        child_events(spark, sf_dir), visits, first_encounters(visits), stage=Staging(spark)
    )


def relink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair of a history table and of an event table, which also loses rows without encounter."""
    staging = Staging(spark)
    visits = staging.table(trimmed_encounters(spark, sf_dir).select("id", "patient", "start"))
    children = staging.table(child_events(spark, sf_dir))
    history = reassign_orphans(children, visits, first_encounters(visits), stage=staging)
    events = delete_orphans(children, visits, keep_null=False)
    return history.withColumn("policy", F.lit("reassign")).unionByName(
        events.withColumn("policy", F.lit("delete"))
    )


# ---- duplicates


def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
        ["l_partkey", "l_suppkey", "l_extendedprice"],
    )


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    )


# ---- codes


def _coded(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return tables(spark, sf_dir, "part", "nation", "region", "events")


def _pairs(spark: SparkSession, sf_dir: str, *vocabs: str) -> DataFrame:
    return code_pairs(_coded(spark, sf_dir), [b for v in vocabs for b in CODE_SOURCES[v]])


def codes_snomed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_description(_pairs(spark, sf_dir, "SNOMED").where(F.col("code").isNotNull()))


def codes_rxnorm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_description(_pairs(spark, sf_dir, "RxNorm"))


def codes_cvx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir, "CVX")


def codes_loinc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_description(_pairs(spark, sf_dir, "LOINC"), {"LOINC": LONGEST_RULE})


def codes_dicom(spark: SparkSession, sf_dir: str) -> DataFrame:
    modality = _pairs(spark, sf_dir, "DICOM-DCM")
    return modality.unionByName(one_description(_pairs(spark, sf_dir, "DICOM-SOP")))


def codes_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_codes(_coded(spark, sf_dir), [b for branches in CODE_SOURCES.values() for b in branches])


def codes_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes per vocabulary and how many break the key."""
    codes = codes_all(spark, sf_dir)
    counted = codes.groupBy("vocab", "code").agg(F.count("*").alias("n"))
    return counted.groupBy("vocab").agg(
        F.count("*").alias("n_codes"),
        F.count_if((F.col("n") > 1) | F.col("code").isNull()).alias("n_violations"),
    )


def codes_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = Staging(spark).table(codes_all(spark, sf_dir))
    coded = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("code"), F.col("p_name").alias("description")
    )
    return lookup_descriptions(drop_descriptions(coded, "SNOMED"), codes)


# ---- audits


def pk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tables(spark, sf_dir, "lineitem", "orders", "customer", "nation", "part", "supplier")
    found["lineitem"] = _loose_lines(spark, sf_dir)
    found["encounters"] = trimmed_encounters(spark, sf_dir)
    return audit.reference_report(found, [
        audit.ForeignKey("lineitem", "l_orderkey", "encounters"),
        audit.ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
        audit.ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        audit.ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
        audit.ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    ])


def length_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = audit.length_report(table(spark, sf_dir, "documents"))
    pages = audit.length_report(table(spark, sf_dir, "pages"), {"url": 64, "html": 1024})
    return documents.withColumn("table_name", F.lit("documents")).unionByName(
        pages.withColumn("table_name", F.lit("pages"))
    )


# ---- common data model


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate_keys(table(spark, sf_dir, "customer"), ["c_custkey"], "person_id", Staging(spark))


def kept_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons numbered by two loads: two thirds of the customers, then all of them."""
    staging = Staging(spark)
    store = KeyStore(spark, staging.path("person_keys"), {"c_custkey": "bigint"}, "person_id")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    store.extend(customers.where(F.col("c_custkey") % 3 != 0), staging)
    return store.add(customers, staging)


def visit_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roll_up_visits(encounters(spark, sf_dir), ["patient"], gap_days=30)


def visit_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits after two loads, the second of them repeated."""
    staging, orders = Staging(spark), encounters(spark, sf_dir)
    store = VisitStore(spark, staging.path("visits"), ["patient"], gap_days=30)
    late = F.col("id") % 3 == 0
    store.add("late", orders.where(late), staging)
    for _ in range(2):
        store.add("rest", orders.where(~late), staging)
    return store.visits()


def visit_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = ["patient", "class"]
    orders = encounters(spark, sf_dir)
    _, cells = number_visits(visit_cells(orders, by, gap_days=30), by, Staging(spark))
    visits = visit_of_encounter(orders, cells, by, gap_days=30)
    lines = _loose_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return assign_visits(lines, visits, encounter="l_orderkey")


def concept_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = F.explode(F.array(F.lit("A"), F.lit("N")))
    concepts = table(spark, sf_dir, "supplier").select(
        vocabularies.alias("vocabulary_id"),
        F.col("s_suppkey").cast("string").alias("concept_code"),
        (F.col("s_suppkey") + 1000).alias("concept_id"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_returnflag").alias("vocab"),
        F.when(F.col("l_partkey") % 5 != 0, F.col("l_suppkey").cast("string")).alias("code"),
    )
    return map_concepts(lines, concepts, stage=Staging(spark))


def concept_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as concepts in blocks of forty, each replaced by the next.

    The first of a block maps past the second; the last is standard unless its part has size 1; every fifth block runs
    in a circle. Links of parts with size 50 are not valid.
    """
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_size")
    block, place = F.floor(F.col("id") / 40), F.col("id") % 40
    circle = block % 5 == 0
    concepts = part.select(
        F.col("id").alias("concept_id"), F.when((place == 39) & ~circle, F.lit("S")).alias("standard_concept"),
        F.when(F.col("p_size") == 1, F.lit("D")).alias("invalid_reason"))
    none = F.when(F.col("p_size") == 50, F.lit("D"))
    follow = F.when(place < 39, F.col("id") + 1).otherwise(F.col("id") - 39)
    replaced = part.where((place < 39) | circle).select(
        F.col("id").alias("concept_id_1"), follow.alias("concept_id_2"), F.lit("Concept replaced by").alias("relationship_id"),
        none.alias("invalid_reason"))
    mapped = part.where(place == 0).select(
        F.col("id").alias("concept_id_1"), (F.col("id") + 2).alias("concept_id_2"), F.lit("Maps to").alias("relationship_id"),
        none.alias("invalid_reason"))
    return concept_targets(concepts, replaced.unionByName(mapped), Staging(spark))


def event_union_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [
        EventSource("drug_exposure", "lineitem", "RxNorm", code="l_partkey", start="l_shipdate", stop=None),
        EventSource("measurement", "events", "LOINC", person="user_id", encounter=None, code="event_type",
                    start="ts", stop=None),
    ]
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("encounter"), "l_partkey", "l_shipdate"
    )
    owner = encounters(spark, sf_dir).select(F.col("id").alias("_id"), "patient")
    lines = lines.join(owner, F.col("encounter") == F.col("_id"), "left")
    return event_union({"lineitem": lines, "events": table(spark, sf_dir, "events")}, sources)


def _clinical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Patients, encounters and events under the column names of the clinical tables.

    All lineitems are the rows of each event table; those of line 7 have a code that no vocabulary knows.
    """
    known = F.col("l_partkey").cast("string")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("encounter"),
        F.when(F.col("l_linenumber") == 7, F.concat(F.lit("X"), known)).otherwise(known).alias("code"),
        F.col("l_shipdate").alias("start"), F.col("l_shipdate").alias("stop"), F.col("l_shipdate").alias("date"),
    )
    visits = encounters(spark, sf_dir)
    owner = visits.select(F.col("id").alias("_id"), "patient")
    events = lines.join(owner, F.col("encounter") == F.col("_id"), "left").drop("_id")
    return {
        "patients": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"),
            F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int")).alias("birthdate"),
            F.when(F.col("c_custkey") % 10 == 0, F.lit("2000-01-01").cast("date")).alias("deathdate"),
        ),
        "encounters": visits.select(
            "id", "patient", "start", "stop",
            F.when(F.col("class") == "O", "inpatient").when(F.col("class") == "F", "emergency")
            .otherwise("wellness").alias("encounterclass"),
        ),
        **{name: events for name in ("conditions", "medications", "procedures", "observations", "devices", "allergies")},
    }


def _concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = F.explode(F.array(*[F.lit(v) for v in ("RxNorm", "SNOMED", "LOINC")]))
    return table(spark, sf_dir, "part").select(
        vocabularies.alias("vocabulary_id"), F.col("p_partkey").cast("string").alias("concept_code"),
        (F.col("p_partkey") + 1000).alias("concept_id"),
    )


def _omop(spark: SparkSession, sf_dir: str, target: str) -> DataFrame:
    found = omop_convert(_clinical_tables(spark, sf_dir), _concepts(spark, sf_dir), Staging(spark), targets=[target])
    return found[target]


def omop_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return person_table(_clinical_tables(spark, sf_dir)["patients"], Staging(spark)).drop("death_date")


def omop_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "visit_occurrence")


def omop_death(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "death")


def omop_drug_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "drug_exposure")


def omop_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedures of all event tables, by the domain of the standard concept that a code's chain ends at.

    Every third part is standard and the others map to the next part; the domains of parts take turns.
    """
    vocabularies = F.posexplode(F.array(*[F.lit(v) for v in ("RxNorm", "SNOMED", "LOINC")])).alias("v", "vocabulary_id")
    key = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", vocabularies)
    domains = F.array(*[F.lit(d) for d in ("Condition", "Drug", "Procedure", "Spec Anatomic Site")])
    concepts = part.select(
        (key * 10 + F.col("v")).alias("concept_id"), "vocabulary_id", key.cast("string").alias("concept_code"),
        F.element_at(domains, (key % 4 + 1).cast("int")).alias("domain_id"),
        F.when(key % 3 == 0, F.lit("S")).alias("standard_concept"), F.lit(None).cast("string").alias("invalid_reason"))
    links = part.where(key % 3 != 0).select(
        (key * 10 + F.col("v")).alias("concept_id_1"), (key * 10 + 10 + F.col("v")).alias("concept_id_2"),
        F.lit("Maps to").alias("relationship_id"), F.lit(None).cast("string").alias("invalid_reason"))
    found = omop_convert(
        _clinical_tables(spark, sf_dir), concepts, Staging(spark), targets=["procedure_occurrence"], relationship=links)
    return found["procedure_occurrence"]


def omop_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "condition_occurrence")


def omop_procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "procedure_occurrence")


def omop_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "measurement")


def omop_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "device_exposure")


def omop_observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _omop(spark, sf_dir, "observation")


def codes_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedures with two described codes, normalized and restored from the dictionary."""
    procedures = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("code"), F.col("p_name").alias("description"),
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("reasoncode"),
        F.col("p_name").alias("reasondescription"),
    )
    clinical = {"procedures": procedures}
    codes = Staging(spark).table(build_codes(clinical, [b for b in CODE_BRANCHES if b.table == "procedures"]))
    return denormalize(normalize(clinical), codes)["procedures"]


QUERIES = {
    "relink": relink,
    "csv_scan": csv_scan,
    "csv_quoted_breaks": csv_quoted_breaks,
    "manifest_counts": manifest_counts,
    "manifest_select": manifest_select,
    "schema_probe": schema_probe,
    "parse_dates": parse_dates_query,
    "note_file_id": note_file_id,
    "note_segments": note_segments,
    "note_files": note_files,
    "literal_table": literal_table,
    "sink_overwrite": sink_overwrite,
    "sink_append": sink_append,
    "vocab_load": vocab_load,
    "layout_roundtrip": layout_roundtrip,
    "layout_curve": layout_curve,
    "sink_append_new": sink_append_new,
    "load_table": load_table_query,
    "lower_columns": lower_columns_query,
    "launch_trim": launch_trim_query,
    "history_window": history_window_query,
    "npi_filter": npi_filter,
    "provider_plan": provider_plan,
    "provider_lists": provider_lists,
    "drop_null_encounter": drop_null_encounter_query,
    "rename_roundtrip": rename_roundtrip,
    "cast_codes": cast_codes_query,
    "cast_timestamptz": cast_timestamptz,
    "type_map": type_map,
    "drop_descriptions": drop_descriptions_query,
    "first_encounter": first_encounter,
    "first_value_window": first_value_window,
    "orphans": orphans_query,
    "delete_orphans": delete_orphans_query,
    "reassign_orphans": reassign_orphans_query,
    "dedup_by_id": dedup_by_id,
    "dedup_rows": dedup_rows,
    "codes_snomed": codes_snomed,
    "codes_rxnorm": codes_rxnorm,
    "codes_cvx": codes_cvx,
    "codes_loinc": codes_loinc,
    "codes_dicom": codes_dicom,
    "codes_all": codes_all,
    "codes_pk": codes_pk,
    "codes_lookup": codes_lookup,
    "pk_audit": pk_audit,
    "fk_audit": fk_audit,
    "length_audit": length_audit,
    "surrogate_key": surrogate_key,
    "kept_keys": kept_keys,
    "visit_rollup": visit_rollup,
    "visit_loads": visit_loads,
    "visit_assign": visit_assign,
    "concept_map": concept_map,
    "concept_closure": concept_closure,
    "event_union": event_union_query,
    "omop_person": omop_person,
    "omop_visit": omop_visit,
    "omop_drug_exposure": omop_drug_exposure,
    "omop_death": omop_death,
    "omop_condition": omop_condition,
    "omop_routed": omop_routed,
    "omop_procedure": omop_procedure,
    "omop_measurement": omop_measurement,
    "omop_device": omop_device,
    "omop_observation": omop_observation,
    "codes_roundtrip": codes_roundtrip,
}
