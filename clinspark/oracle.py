"""The same results in ANSI SQL (DuckDB dialect) over the same tables."""

from __future__ import annotations

_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_returnflag l_linestatus l_shipdate"
    ),
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}

_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _COLUMNS
)

_PROBE = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({i} AS BIGINT) AS position, "
    f"count(*) AS n_rows FROM {t}"
    for t, columns in _COLUMNS.items()
    for i, c in enumerate(columns.split())
)

_VISITS = """
  e AS (SELECT o_orderkey AS id, o_custkey AS patient, o_orderdate AS start
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
  f AS (SELECT DISTINCT patient,
               first_value(id) OVER (PARTITION BY patient ORDER BY start, id) AS first_encounter_id
        FROM e),
  c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               CASE WHEN l_partkey % 7 <> 0 THEN l_orderkey END AS encounter, o_custkey AS patient
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)
"""

#: Lineitems of which every seventh has lost its encounter.
_NULLED = "SELECT * REPLACE (CASE WHEN l_partkey % 7 <> 0 THEN l_orderkey END AS l_orderkey) FROM lineitem"

_REASSIGNED = """
  SELECT c.l_orderkey, c.l_linenumber, c.l_partkey, c.l_suppkey, c.l_extendedprice,
         CASE WHEN c.encounter IS NOT NULL AND e.id IS NULL THEN f.first_encounter_id ELSE c.encounter END AS encounter,
         c.patient
  FROM c LEFT JOIN e ON c.encounter = e.id LEFT JOIN f ON c.patient = f.patient
"""

_SNOMED = """
  SELECT 'SNOMED' AS vocab, p_brand AS code, lower(p_name) AS description FROM part
  UNION SELECT 'SNOMED', p_type, lower(p_name) FROM part
  UNION SELECT 'SNOMED', CAST(n_nationkey AS VARCHAR), lower(n_name) FROM nation
  UNION SELECT 'SNOMED', CAST(r_regionkey AS VARCHAR), lower(r_name) FROM region
"""

_ALL_CODES = f"""
  SELECT vocab, code, min(description) AS description FROM (
    {_SNOMED}
    UNION ALL SELECT 'RxNorm', event_type, lower(props) FROM events
    UNION ALL SELECT 'CVX', event_type, lower(props) FROM events
    UNION ALL SELECT 'DICOM-DCM', p_brand, lower(p_type) FROM part
    UNION ALL SELECT 'DICOM-SOP', p_type, lower(p_name) FROM part
  ) WHERE code IS NOT NULL GROUP BY vocab, code
  UNION ALL
  SELECT * FROM (
    SELECT DISTINCT ON (p_brand) 'LOINC' AS vocab, p_brand AS code, lower(p_name) AS description
    FROM part ORDER BY p_brand, length(lower(p_name)) DESC, lower(p_name) DESC)
"""


def _roll_up(by: str) -> str:
    """Encounters numbered by visit; ``by`` is a list of columns."""
    return f"""
  o AS (SELECT o_orderkey AS id, o_custkey AS patient, o_orderstatus AS class, o_orderdate AS start,
               o_orderdate AS stop FROM orders),
  r AS (SELECT *, max(stop) OVER (PARTITION BY {by} ORDER BY start, id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o),
  g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach + INTERVAL 30 DAY THEN 1 ELSE 0 END)
                  OVER (PARTITION BY {by} ORDER BY start, id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS visit FROM r)
"""


_OMOP = """
  o AS (SELECT o_orderkey AS id, o_custkey AS patient, o_orderdate AS start,
               CASE o_orderstatus WHEN 'O' THEN 'inpatient' WHEN 'F' THEN 'emergency' ELSE 'wellness' END AS class
        FROM orders),
  r AS (SELECT *, max(start) OVER (PARTITION BY patient, class ORDER BY start, id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM o),
  g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach + INTERVAL 1 DAY THEN 1 ELSE 0 END)
                  OVER (PARTITION BY patient, class ORDER BY start, id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS visit FROM r),
  v AS (SELECT patient, class, visit, min(start) AS first_start, max(start) AS last_start,
               row_number() OVER (ORDER BY patient, class, min(start)) AS visit_occurrence_id
        FROM g GROUP BY patient, class, visit),
  p AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS person_id FROM customer)
"""

_TYPES = (
    ("l_orderkey", "bigint", "NULL"), ("code", "string", "32"), ("l_suppkey", "bigint", "NULL"),
    ("l_linenumber", "bigint", "NULL"), ("l_quantity", "double", "NULL"),
    ("l_extendedprice", "double", "NULL"), ("l_discount", "double", "NULL"), ("l_tax", "double", "NULL"),
    ("encounter", "string", "64"), ("l_linestatus", "string", "1024"), ("birthdate", "date", "NULL"),
)

#: Of each event table: its name, its key, its first date, its last date.
_EVENTS = {
    "drug_exposure": ("drug_exposure", "drug", "drug_exposure_start", "drug_exposure_end"),
    "condition": ("condition_occurrence", "condition", "condition_start", "condition_end"),
    "procedure": ("procedure_occurrence", "procedure", "procedure", "procedure_end"),
    "measurement": ("measurement", "measurement", "measurement", None),
    "device": ("device_exposure", "device", "device_exposure_start", "device_exposure_end"),
    "observation": ("observation", "observation", "observation", None),
}


def _event_sql(name: str, key: str, first: str, last: str | None) -> str:
    """All lineitems as events; the concept of line 7 is unknown."""
    ends = f"CAST(l_shipdate AS DATE) AS {last}_date, l_shipdate AS {last}_datetime," if last else ""
    end_names = f"{last}_date, {last}_datetime," if last else ""
    return f"""WITH {_OMOP},
  rows AS (SELECT person_id,
    CAST(CASE WHEN l_linenumber <> 7 AND p_partkey IS NOT NULL THEN p_partkey + 1000 ELSE 0 END AS BIGINT) AS {key}_concept_id,
    CAST(l_shipdate AS DATE) AS {first}_date, l_shipdate AS {first}_datetime, {ends} visit_occurrence_id,
    CASE WHEN l_linenumber = 7 THEN 'X' ELSE '' END || CAST(l_partkey AS VARCHAR) AS {key}_source_value
  FROM lineitem LEFT JOIN g ON l_orderkey = g.id
    LEFT JOIN v ON g.patient = v.patient AND g.class = v.class AND g.visit = v.visit
    LEFT JOIN p ON g.patient = c_custkey LEFT JOIN part ON l_partkey = p_partkey)
  SELECT row_number() OVER (ORDER BY person_id NULLS FIRST, {key}_concept_id, {first}_date, {first}_datetime, {end_names}
    visit_occurrence_id NULLS FIRST, {key}_source_value) AS {name}_id, * FROM rows"""


ORACLE_SQL = {
    "relink": f"""WITH {_VISITS}
  SELECT *, 'reassign' AS policy FROM ({_REASSIGNED})
  UNION ALL
  SELECT *, 'delete' AS policy FROM c WHERE encounter IN (SELECT id FROM e)""",
    "csv_scan": "SELECT * FROM orders",
    "csv_quoted_breaks": "SELECT doc_id, source, nullif(text, '') AS text, lang FROM documents",
    "manifest_counts": _COUNTS,
    "manifest_select": f"""WITH counts AS ({_COUNTS})
  SELECT 'include' AS selection, * FROM counts WHERE table_name IN ('orders', 'lineitem')
  UNION ALL SELECT 'exclude', * FROM counts WHERE table_name <> 'embeddings'
  UNION ALL SELECT 'both', * FROM counts
  UNION ALL SELECT 'neither', * FROM counts""",
    "schema_probe": _PROBE,
    "parse_dates": """SELECT o_orderkey, o_orderdate AS start, CAST(o_orderdate AS DATE) AS birthdate FROM orders""",
    "note_file_id": """SELECT c_custkey, file_name,
    nullif(regexp_extract(file_name, '(^.*_)(.*?).txt', 2), '') AS patient FROM (
      SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'notes' || c_custkey || '.txt'
        ELSE replace(c_name, '#', '_') || '_' || c_custkey || '.txt' END AS file_name FROM customer)""",
    "note_segments": """SELECT DATE '2020-01-01' + CAST(i - 1 AS INTEGER) AS date, lines[i] AS note_text, patient
    FROM (SELECT CAST(doc_id AS VARCHAR) AS patient, string_split(text, chr(10)) AS lines,
                 unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)""",
    "note_files": """SELECT DATE '2020-01-01' + CAST(turn AS INTEGER) AS date, text AS note_text,
    CAST(conv_id AS VARCHAR) AS patient FROM conversations""",
    "literal_table": """SELECT * FROM (VALUES
    (CAST(4001 AS BIGINT), 'Medstar Promptcare - Adams Morgan', 'WASHINGTON', CAST(20009 AS BIGINT),
     'URGENT MEDICAL CARE CENTERS AND CLINICS (EXCEPT HOSPITALS), FREESTANDING',
     CAST(38.922567 AS DOUBLE), CAST(-77.043162 AS DOUBLE), 'urgent care'),
    (4002, 'Medstar Promptcare - Capitol Hill ', 'WASHINGTON', 20003,
     'URGENT MEDICAL CARE CENTERS AND CLINICS (EXCEPT HOSPITALS), FREESTANDING',
     38.886417, -76.995996, 'urgent care')) AS v(id, name, city, zip, type, "LAT", "LON", list)
  UNION ALL SELECT s_suppkey, s_name, NULL, NULL, NULL, NULL, NULL, 'supplier' FROM supplier""",
    "sink_overwrite": "SELECT * FROM customer",
    "sink_append": """SELECT *, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'before' ELSE 'after' END
    AS run_id FROM orders""",
    "vocab_load": """SELECT p_partkey AS concept_id, p_name AS concept_name, 'Device' AS domain_id,
    p_brand AS vocabulary_id, p_type AS concept_class_id,
    CASE WHEN p_size > 25 THEN 'S' END AS standard_concept, CAST(p_partkey AS VARCHAR) AS concept_code,
    DATE '1970-01-01' + p_size AS valid_start_date, DATE '2099-12-31' AS valid_end_date,
    CASE WHEN p_size = 1 THEN 'D' END AS invalid_reason FROM part""",
    "layout_roundtrip": "SELECT * FROM lineitem",
    "layout_curve": "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'",
    "sink_append_new": "SELECT *, CASE WHEN o_orderkey % 3 < 2 THEN 'a' ELSE 'b' END AS run_id FROM orders",
    "load_table": """SELECT id, code, supplier, base_cost, description, start FROM (
    SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_partkey AS VARCHAR) AS code,
      l_suppkey AS supplier, l_extendedprice AS base_cost, l_returnflag AS description,
      l_shipdate AS start,
      row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                         ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01') WHERE rn = 1""",
    "lower_columns": "SELECT * FROM part",
    "launch_trim": "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
    "history_window": """SELECT * FROM orders
    WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 36 MONTH FROM orders)""",
    "npi_filter": "SELECT * FROM supplier WHERE s_suppkey IN (1, 4, 9)",
    "provider_plan": """SELECT supplier.*, target FROM supplier JOIN (VALUES
    (1, 'hospice'), (1, 'dialysis'), (2, 'dialysis'), (1, 'hospitals'), (2, 'hospitals'),
    (3, 'primary'), (4, 'primary'), (5, 'primary'),
    (3, 'primary_children'), (4, 'primary_children'), (5, 'primary_children'),
    (3, 'primary_women'), (4, 'primary_women'), (5, 'primary_women')) AS p(npi, target)
    ON s_suppkey = npi""",
    "drop_null_encounter": f"""WITH {_VISITS}
  SELECT * FROM ({_REASSIGNED}) WHERE encounter IS NOT NULL""",
    "rename_roundtrip": "SELECT * FROM orders",
    "cast_codes": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
    CAST(p_size AS VARCHAR) AS p_size, p_retailprice FROM part""",
    "cast_timestamptz": "SELECT event_id, epoch_us(ts) AS instant_us FROM events",
    "type_map": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS storage_type, CAST({n} AS BIGINT) AS max_length, "
        "count(*) AS n_values, CAST(0 AS BIGINT) AS n_lost FROM lineitem"
        for c, t, n in _TYPES
    ),
    "drop_descriptions": "SELECT p_partkey, p_brand AS code, 'SNOMED' AS vocab FROM part",
    "first_encounter": f"""WITH {_VISITS}
  SELECT c_custkey AS id, c_name, first_encounter_id FROM customer LEFT JOIN f ON c_custkey = f.patient""",
    "first_value_window": f"""WITH {_VISITS}
  SELECT id, patient, start, first_value(id) OVER (PARTITION BY patient ORDER BY start, id)
    AS first_encounter_id FROM e""",
    "orphans": f"""WITH {_VISITS}, n AS ({_NULLED})
  SELECT n.* FROM n LEFT JOIN e ON l_orderkey = e.id WHERE l_orderkey IS NOT NULL AND e.id IS NULL""",
    "delete_orphans": f"""WITH {_VISITS}, n AS ({_NULLED})
  SELECT n.* FROM n WHERE l_orderkey IS NULL OR l_orderkey IN (SELECT id FROM e)""",
    "reassign_orphans": f"WITH {_VISITS} {_REASSIGNED}",
    "dedup_by_id": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM lineitem) WHERE rn = 1""",
    "dedup_rows": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem",
    "codes_snomed": f"""SELECT DISTINCT ON (vocab, code) vocab, code, description FROM ({_SNOMED})
  WHERE code IS NOT NULL ORDER BY vocab, code, description""",
    "codes_rxnorm": """SELECT 'RxNorm' AS vocab, event_type AS code, min(lower(props)) AS description
    FROM events GROUP BY event_type""",
    "codes_cvx": "SELECT DISTINCT 'CVX' AS vocab, event_type AS code, lower(props) AS description FROM events",
    "codes_loinc": """SELECT DISTINCT ON (p_brand) 'LOINC' AS vocab, p_brand AS code, lower(p_name) AS description
    FROM part ORDER BY p_brand, length(lower(p_name)) DESC, lower(p_name) DESC""",
    "codes_dicom": """SELECT DISTINCT 'DICOM-DCM' AS vocab, p_brand AS code, lower(p_type) AS description FROM part
    UNION SELECT 'DICOM-SOP', p_type, min(lower(p_name)) FROM part GROUP BY p_type""",
    "codes_all": _ALL_CODES,
    "codes_pk": f"""SELECT vocab, count(*) AS n_codes,
    CAST(sum(CASE WHEN n > 1 OR code IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_violations
    FROM (SELECT vocab, code, count(*) AS n FROM ({_ALL_CODES}) GROUP BY vocab, code) GROUP BY vocab""",
    "codes_lookup": f"""SELECT p_partkey, p_brand AS code, 'SNOMED' AS vocab, d.description FROM part
    LEFT JOIN (SELECT * FROM ({_ALL_CODES}) WHERE vocab = 'SNOMED') d ON p_brand = d.code""",
    "pk_audit": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "fk_audit": " UNION ALL ".join(
        f"SELECT '{child}' AS table_name, '{column}' AS column_name, count(*) AS n_rows, "
        f"count(*) - count({column}) AS n_null, "
        f"CAST(coalesce(sum(CASE WHEN {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {key} FROM {parent}) THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_orphan "
        f"FROM {f'({_NULLED})' if child == 'lineitem' else child}"
        for child, column, parent, key in (
            ("lineitem", "l_orderkey", "(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"),
        )
    ),
    "length_audit": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({n} AS BIGINT) AS max_allowed, "
        f"max(length({c})) AS max_found, max(length({c})) > {n} AS too_long FROM {t}"
        for t, c, n in (
            ("documents", "text", 1024), ("documents", "lang", 1024), ("documents", "source", 1024),
            ("pages", "url", 64), ("pages", "html", 1024),
        )
    ),
    "surrogate_key": "SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS person_id FROM customer",
    "kept_keys": """SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey % 3 = 0, c_custkey) AS person_id
    FROM customer""",
    "concept_closure": """WITH RECURSIVE
  c AS (SELECT p_partkey AS id, p_partkey % 40 AS place, p_partkey // 40 % 5 = 0 AS circle, p_size FROM part),
  n AS (SELECT id, CASE WHEN place = 0 THEN id + 2 WHEN place < 39 THEN id + 1 ELSE id - 39 END AS next
        FROM c WHERE p_size <> 50 AND (circle OR place < 39)),
  w AS (SELECT id, id AS last, 0 AS n_steps FROM c
        UNION ALL SELECT w.id, next, n_steps + 1 FROM w JOIN n ON w.last = n.id WHERE n_steps < 100),
  e AS (SELECT w.id AS concept_id, max(n_steps) AS n_steps, arg_max(w.last, n_steps) AS last FROM w GROUP BY w.id),
  s AS (SELECT e.*, CASE WHEN c.place = 39 AND NOT circle AND p_size <> 1 THEN last END AS target_id
        FROM e LEFT JOIN c ON last = c.id)
  SELECT concept_id, CASE WHEN n_steps < 100 THEN target_id END AS target_id,
    CASE WHEN n_steps < 100 THEN CAST(n_steps AS BIGINT) END AS n_steps,
    CASE WHEN n_steps = 100 THEN 'cycle' WHEN target_id IS NULL THEN 'no standard' WHEN n_steps = 0 THEN 'standard'
         ELSE 'mapped' END AS state
  FROM s""",
    "omop_routed": f"""WITH {_OMOP},
  m AS (SELECT a.p_partkey AS code, b.p_partkey AS standard FROM part AS a
        LEFT JOIN part AS b ON b.p_partkey = a.p_partkey + (3 - a.p_partkey % 3) % 3),
  x AS (SELECT * FROM (VALUES ('conditions', 1), ('medications', 0), ('procedures', 1), ('observations', 2), ('devices', 1),
          ('allergies', 1)) AS t(source, v)),
  rows AS (SELECT person_id,
    CAST(CASE WHEN l_linenumber <> 7 AND standard IS NOT NULL THEN standard * 10 + v ELSE 0 END AS BIGINT) AS procedure_concept_id,
    CAST(l_shipdate AS DATE) AS procedure_date, l_shipdate AS procedure_datetime,
    CAST(l_shipdate AS DATE) AS procedure_end_date, l_shipdate AS procedure_end_datetime, visit_occurrence_id,
    CASE WHEN l_linenumber = 7 THEN 'X' ELSE '' END || CAST(l_partkey AS VARCHAR) AS procedure_source_value,
    CAST(CASE WHEN l_linenumber <> 7 AND code IS NOT NULL THEN code * 10 + v ELSE 0 END AS BIGINT) AS procedure_source_concept_id
  FROM lineitem CROSS JOIN x LEFT JOIN g ON l_orderkey = g.id
    LEFT JOIN v ON g.patient = v.patient AND g.class = v.class AND g.visit = v.visit
    LEFT JOIN p ON g.patient = c_custkey LEFT JOIN m ON l_partkey = code
  WHERE CASE WHEN l_linenumber = 7 OR standard IS NULL OR standard % 4 = 3 THEN source = 'procedures' ELSE standard % 4 = 2 END)
  SELECT row_number() OVER (ORDER BY person_id NULLS FIRST, procedure_concept_id, procedure_date, procedure_datetime,
    procedure_end_date, procedure_end_datetime, visit_occurrence_id NULLS FIRST, procedure_source_value,
    procedure_source_concept_id) AS procedure_occurrence_id, * FROM rows""",
    "visit_rollup": f"""WITH {_roll_up("patient")}
  SELECT patient, min(start) AS visit_start, max(stop) AS visit_end, count(*) AS n_encounters
  FROM g GROUP BY patient, visit""",
    "visit_loads": f"""WITH {_roll_up("patient")}
  SELECT patient, min(start) AS visit_start, max(stop) AS visit_end, count(*) AS n_encounters
  FROM g GROUP BY patient, visit""",
    "visit_assign": f"""WITH {_roll_up("patient, class")},
  v AS (SELECT patient, class, visit, row_number() OVER (ORDER BY patient, class, min(start))
               AS visit_occurrence_id FROM g GROUP BY patient, class, visit)
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, visit_occurrence_id
  FROM ({_NULLED}) LEFT JOIN g ON l_orderkey = g.id
    LEFT JOIN v ON g.patient = v.patient AND g.class = v.class AND g.visit = v.visit""",
    "concept_map": """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS vocab,
    CASE WHEN l_partkey % 5 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS code,
    CASE WHEN l_partkey % 5 <> 0 AND l_returnflag IN ('A', 'N') AND s_suppkey IS NOT NULL THEN s_suppkey + 1000 ELSE 0 END
      AS concept_id
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "event_union": """SELECT 'drug_exposure' AS target, o_custkey AS person_source_value, l_orderkey AS encounter,
    'RxNorm' AS vocab, CAST(l_partkey AS VARCHAR) AS code, l_shipdate AS start_datetime, l_shipdate AS end_datetime
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT 'measurement', user_id, NULL, 'LOINC', event_type, ts, ts FROM events""",
    "provider_lists": """SELECT s_suppkey - 1 AS index, s_suppkey AS npi, s_name AS name, target
    FROM supplier JOIN (VALUES (1, 'hospice.csv'), (1, 'dialysis.csv'), (2, 'dialysis.csv'),
      (1, 'hospitals.csv'), (2, 'hospitals.csv')) AS a(n, target) ON s_suppkey = n
    UNION ALL SELECT c_custkey - 1, c_custkey, c_name, target
    FROM customer JOIN (VALUES (3, 'rehab.csv'), (5, 'rehab.csv'), (5, 'women.csv')) AS b(n, target)
      ON c_custkey = n""",
    "omop_person": """SELECT row_number() OVER (ORDER BY c_custkey) AS person_id,
    year(birth) AS year_of_birth, month(birth) AS month_of_birth, day(birth) AS day_of_birth,
    CAST(birth AS TIMESTAMP) AS birth_datetime, c_custkey AS person_source_value
    FROM (SELECT c_custkey, DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS birth FROM customer)""",
    "omop_visit": f"""WITH {_OMOP}
  SELECT visit_occurrence_id, person_id,
    CAST(CASE class WHEN 'inpatient' THEN 9201 WHEN 'emergency' THEN 9203 ELSE 9202 END AS BIGINT) AS visit_concept_id,
    CAST(first_start AS DATE) AS visit_start_date, first_start AS visit_start_datetime,
    CAST(last_start AS DATE) AS visit_end_date, last_start AS visit_end_datetime
  FROM v LEFT JOIN p ON patient = c_custkey""",
    "omop_death": f"""WITH {_OMOP}
  SELECT person_id, DATE '2000-01-01' AS death_date FROM p WHERE c_custkey % 10 = 0""",
    **{f"omop_{name}": _event_sql(*layout) for name, layout in _EVENTS.items()},
    "codes_roundtrip": """WITH d AS (
    SELECT code, min(description) AS description FROM (
      SELECT p_brand AS code, lower(p_name) AS description FROM part
      UNION SELECT p_type, lower(p_name) FROM part WHERE p_size > 10) GROUP BY code)
  SELECT p_partkey AS id, p_brand AS code, CASE WHEN p_size > 10 THEN p_type END AS reasoncode, a.description,
    b.description AS reasondescription
  FROM part LEFT JOIN d AS a ON p_brand = a.code LEFT JOIN d AS b ON p_size > 10 AND p_type = b.code""",
}
