"""The four trial tables, derived from the driver's star-schema test data.

The test data has no trial registry, so `studies`, `sponsors`,
`interventions` and `conditions` are derived from `orders`, `lineitem`,
`supplier`, `part` and `documents` by a fixed rule (FIXTURES.md §2). The rule
is given twice from the same constants: as DataFrame code for Spark, and as
SQL CTE text the DuckDB oracles inline. Every derived row comes from a real
input row, so the work grows with the data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas

# Categorical columns by key modulus; None is a null value.
PHASE_BY_CUSTKEY = (
    "EARLY_PHASE1", "EARLY_PHASE_1", "PHASE1", "PHASE_1", "PHASE1/PHASE2", "PHASE1_2",
    "PHASE2", "PHASE_2", "PHASE2/PHASE3", "PHASE_2_3", "PHASE3", "PHASE_3", "PHASE4",
    "PHASE_4", "NA", "NOT_APPLICABLE", None, "PHASE9",
)
STATUS_BY_ORDERKEY = (
    "NOT_YET_RECRUITING", "RECRUITING", "ENROLLING_BY_INVITATION", "ACTIVE_NOT_RECRUITING",
    "SUSPENDED", "COMPLETED", "TERMINATED", "WITHDRAWN", "UNKNOWN", None, "WITHHELD",
)
START_TYPE_BY_ORDERKEY = ("ACTUAL", "ESTIMATED", None)
PRIMARY_TYPE_BY_ORDERKEY = ("ACTUAL", "ESTIMATED", None, None, None)
COMPLETION_TYPE_BY_ORDERKEY = ("ACTUAL", "ESTIMATED", None, None)
# Sponsor names by key modulus that differ in case or accents only.
SPELLINGS = {17: "Zentrum", 19: "zentrum", 23: "z\u00e9ntrum", 29: "Z\u00e9ntrum", 31: "\u00c9cole", 37: "eclair"}

# The columns that the mapping reads, declared: no job reads footers for them.
COLUMNS = {
    "orders": "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey long, s_name string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string",
    "documents": "doc_id long, text string",
}
TABLES = tuple(COLUMNS)


def read_star(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


# --- Spark -------------------------------------------------------------------

def _by_mod(key: str, values) -> Column:
    return F.expr(_sql_by_mod(key, values))


def _nct(key: str) -> Column:
    return F.expr(f"concat('NCT', lpad(CAST({key} AS STRING), 8, '0'))")


def _studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship = read_star(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    documents = read_star(spark, sf_dir, "documents")
    titles = documents.select("doc_id", F.col("text").alias("brief_title"))
    # every document gives titles: order keys go round the whole table
    n_docs = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    k = F.col("o_orderkey")
    odate = F.col("o_orderdate").cast("date")
    return (
        read_star(spark, sf_dir, "orders")
        # dates first, titles last: a report's date filter is then pushed
        # below the title join and only surviving rows carry their text
        .join(ship, ship["l_orderkey"] == k, "left")
        .join(titles, titles["doc_id"] == k % n_docs, "left")
        .select(
            _nct("o_orderkey").alias("nct_id"),
            F.expr("CASE WHEN o_orderkey % 10 = 9 THEN 'OBSERVATIONAL' ELSE 'INTERVENTIONAL' END").alias("study_type"),
            _by_mod("o_custkey", PHASE_BY_CUSTKEY).alias("phase"),
            _by_mod("o_orderkey", STATUS_BY_ORDERKEY).alias("overall_status"),
            F.col("brief_title"),
            F.when(k % 13 != 0, F.floor(F.col("o_totalprice") / 100).cast("int")).alias("enrollment"),
            F.expr("CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'ACTUAL' ELSE 'ESTIMATED' END")
             .alias("enrollment_type"),
            odate.alias("last_update_posted_date"),
            F.when(k % 17 != 0, odate).alias("start_date"),
            _by_mod("o_orderkey", START_TYPE_BY_ORDERKEY).alias("start_date_type"),
            F.col("first_ship").cast("date").alias("primary_completion_date"),
            _by_mod("o_orderkey", PRIMARY_TYPE_BY_ORDERKEY).alias("primary_completion_date_type"),
            F.col("last_ship").cast("date").alias("completion_date"),
            _by_mod("o_orderkey", COMPLETION_TYPE_BY_ORDERKEY).alias("completion_date_type"),
        )
    )


def _sponsors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # names as registries hold them: missing, blank, padded, with a tab or a
    # no-break space at an end, some that differ in case or accents only
    odd = "".join(f" WHEN {k} THEN '{name}'" for k, name in SPELLINGS.items())
    name = F.expr("CASE l_suppkey % 50 WHEN 0 THEN NULL WHEN 7 THEN concat(' ', char(9), ' ') "
                  "WHEN 11 THEN concat('  ', s_name, ' ') WHEN 13 THEN concat(char(9), s_name, '\u00a0')"
                  f"{odd} ELSE s_name END")
    return (read_star(spark, sf_dir, "lineitem")
            .join(read_star(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(_nct("l_orderkey").alias("nct_id"), name.alias("name"),
                    F.when(F.col("l_linenumber") <= 2, "lead").otherwise("collaborator").alias("lead_or_collaborator")))


def _line_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_star(spark, sf_dir, "lineitem")
            .join(read_star(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")))


def _interventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_part(spark, sf_dir).select(
        _nct("l_orderkey").alias("nct_id"),
        F.when(F.col("l_partkey") % 23 != 0, F.col("p_type")).alias("intervention_type"),
        F.col("p_name").alias("name"),
    )


def _conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line_part(spark, sf_dir).select(
        _nct("l_orderkey").alias("nct_id"),
        F.concat(F.col("p_brand"), F.lit(" "),
                 F.repeat(F.concat(F.col("p_name"), F.lit(" ")), 6)).alias("name"),
    )


class TrialTables(Mapping):
    """studies, sponsors, interventions, conditions as lazy DataFrames, each
    built when asked for. Nothing is kept between calls: every use lists the
    files, analyses the mapping and scans the tables it needs in full."""

    MAKE = {"studies": _studies, "sponsors": _sponsors, "interventions": _interventions, "conditions": _conditions}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return schemas.conform(self.MAKE[name](self.spark, self.sf_dir), schemas.INPUTS[name])

    def __iter__(self):
        return iter(self.MAKE)

    def __len__(self):
        return len(self.MAKE)


def trial_tables(spark: SparkSession, sf_dir: str) -> TrialTables:
    return TrialTables(spark, sf_dir)


def register_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Also expose the four tables as temp views for spark.sql()."""
    tables = dict(trial_tables(spark, sf_dir))
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return tables


# --- SQL text for the DuckDB oracles ----------------------------------------

def _sql_lit(v) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _sql_by_mod(key: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN {_sql_lit(v)}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


def _sql_nct(key: str) -> str:
    return f"concat('NCT', lpad(CAST({key} AS VARCHAR), 8, '0'))"


TABLES_CTE = f"""
studies AS (
  SELECT
    {_sql_nct('o.o_orderkey')} AS nct_id,
    CASE WHEN o.o_orderkey % 10 = 9 THEN 'OBSERVATIONAL' ELSE 'INTERVENTIONAL' END AS study_type,
    {_sql_by_mod('o.o_custkey', PHASE_BY_CUSTKEY)} AS phase,
    {_sql_by_mod('o.o_orderkey', STATUS_BY_ORDERKEY)} AS overall_status,
    d.text AS brief_title,
    CASE WHEN o.o_orderkey % 13 = 0 THEN NULL
         ELSE CAST(floor(o.o_totalprice / 100) AS INTEGER) END AS enrollment,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL
         WHEN o.o_orderkey % 2 = 0 THEN 'ACTUAL' ELSE 'ESTIMATED' END AS enrollment_type,
    CAST(o.o_orderdate AS DATE) AS last_update_posted_date,
    CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS start_date,
    {_sql_by_mod('o.o_orderkey', START_TYPE_BY_ORDERKEY)} AS start_date_type,
    CAST(sh.first_ship AS DATE) AS primary_completion_date,
    {_sql_by_mod('o.o_orderkey', PRIMARY_TYPE_BY_ORDERKEY)} AS primary_completion_date_type,
    CAST(sh.last_ship AS DATE) AS completion_date,
    {_sql_by_mod('o.o_orderkey', COMPLETION_TYPE_BY_ORDERKEY)} AS completion_date_type
  FROM orders o
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey % (SELECT count(*) FROM documents)
  LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
             FROM lineitem GROUP BY l_orderkey) sh ON sh.l_orderkey = o.o_orderkey
),
sponsors AS (
  SELECT {_sql_nct('l.l_orderkey')} AS nct_id,
         CASE l.l_suppkey % 50 WHEN 0 THEN NULL WHEN 7 THEN ' ' || chr(9) || ' '
              WHEN 11 THEN '  ' || s.s_name || ' ' WHEN 13 THEN chr(9) || s.s_name || chr(160)
              {" ".join(f"WHEN {k} THEN '{name}'" for k, name in SPELLINGS.items())}
              ELSE s.s_name END AS name,
         CASE WHEN l.l_linenumber <= 2 THEN 'lead' ELSE 'collaborator' END AS lead_or_collaborator
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
interventions AS (
  SELECT {_sql_nct('l.l_orderkey')} AS nct_id,
         CASE WHEN l.l_partkey % 23 = 0 THEN NULL ELSE p.p_type END AS intervention_type,
         p.p_name AS name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
conditions AS (
  SELECT {_sql_nct('l.l_orderkey')} AS nct_id,
         concat(p.p_brand, ' ', repeat(concat(p.p_name, ' '), 6)) AS name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""
