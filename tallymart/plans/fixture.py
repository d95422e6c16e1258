"""Tally rows derived from the driver's TPC-H-like tables.

The driver tables stand in for the tally files: an order is a polling table
(``mesa``), its customer the precinct (``circuito``), the customer's nation
the section (``seccion``) and that nation's region the district
(``distrito``); a line item is one counted line whose line number is the
code and whose quantity is the count.  A few CASE expressions induce the
edge cases the source files have (sentinels, blanks, negative counts,
malformed numbers, padded text), so every rule has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.plans.layout import BRONZE_COLUMNS, WIDTHS, make_spec
from tallymart.sources.sink import Folder
from tallymart.spec import ClassRule, SourceSpec, text_schema

# --- Fixed values of the fixture spec ----------------------------------------
FIXTURE_TOTALS = {
    "000": "inscriptos",
    "003": "votos_blanco",
    "004": "votos_nulos",
    "005": "votos_recurridos",
    "006": "votos_impugnados",
    "007": "votos_totales",
}
FIXTURE_TOTAL_CODE = "007"
FIXTURE_CATEGORIES = ["AF", "AO", "NF", "NO", "RF"]
FIXTURE_REGIONS = {"00": "AFRICA", "01": "AMERICA", "02": "ASIA", "03": "EUROPE"}
# Order and customer keys grow with the scale: wide enough that no id is cut.
FIXTURE_WIDTHS = {**WIDTHS, "circuito": 12, "mesa": 12}
FIXTURE_PATTERN_A = "NATION_1"
FIXTURE_PATTERN_B = "NATION_2"
# Bytes of line item files (about 230,000 rows) that one task joins or one
# bucket holds: what a task keeps in memory does not grow with the input.
SHARE_BYTES = 4 << 20
# -----------------------------------------------------------------------------

_VALUES = dict(
    source=SourceSpec(schema=text_schema(BRONZE_COLUMNS)),
    totals=FIXTURE_TOTALS,
    total_code=FIXTURE_TOTAL_CODE,
    inscribed_code="000",
    inscribed_label="INSCRIPTOS",
    categories=FIXTURE_CATEGORIES,
    class_rules=(
        ClassRule("COMPENSATORIA", "cantidad < 0"),
        ClassRule("RESIDENTES_EXTERIOR", f"upper(coalesce(seccion_descripcion, '')) rlike '{FIXTURE_PATTERN_A}'"),
        ClassRule("PRIVADOS_LIBERTAD", f"upper(coalesce(seccion_descripcion, '')) rlike '{FIXTURE_PATTERN_B}'"),
    ),
    district_names=FIXTURE_REGIONS,
    widths=FIXTURE_WIDTHS,
)

FIXTURE = make_spec(**_VALUES)
#: The same with one row per key of sections, circuits and the mart.
ONE_SPELLING = make_spec(**_VALUES, one_spelling=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shares(spark: SparkSession, sf_dir: str) -> int:
    """Number of tasks or buckets for work on the line items, by the length of
    their files; no data is read."""
    folder = Folder(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    length = folder.fs.getContentSummary(folder._of(folder.path)).getLength()
    return max(1, -(-length // SHARE_BYTES))


def mesas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its geography: orders joined to customer and
    nation.  Joined before line items so the large side is shuffled once, on
    the order key only."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )


def tally_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tally rows (all text, untrimmed, with sentinels) - the bronze input."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_suppkey"
    )
    # Line items are the fact side: join them by shuffle (sort-merge), never
    # by broadcast.  Without CBO, Spark's size estimate of the joined orders
    # side is the product of its inputs, so at small scale it would broadcast
    # the line items instead (measured ~30% slower at sf0.1); at large scale
    # it picks this same sort-merge join on its own.
    tables = mesas(spark, sf_dir)
    # Spark would merge shuffle partitions into about one per core, up to 64 MB
    # compressed, and a join has several times as much in memory.  Few shares
    # are left to it: a task costs about 0.4 s whatever it reads.
    n = shares(spark, sf_dir)
    if n > 4 * spark.sparkContext.defaultParallelism:
        li, tables = li.repartition(n, "l_orderkey"), tables.repartition(n, "o_orderkey")
    rows = li.hint("merge").join(tables, F.col("l_orderkey") == F.col("o_orderkey"))
    qty = F.col("l_quantity").cast("int")
    cant = (
        F.when((F.col("l_discount") == F.lit(0.1)) & (F.col("l_tax") == F.lit(0.08)), F.lit("1.5"))
        .when((F.col("l_discount") == F.lit(0.0)) & (F.col("l_tax") == F.lit(0.0)), (-qty).cast("string"))
        .otherwise(qty.cast("string"))
    )
    totins = F.when(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("n/a")
    ).otherwise(F.floor(F.col("o_totalprice") / 100).cast("bigint").cast("string"))
    return rows.select(
        F.col("n_regionkey").cast("string").alias("dist_codigo"),
        F.col("c_nationkey").cast("string").alias("secc_codigo"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("secc_descrip"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("\\N"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("circ_codigo"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("")).otherwise(F.col("c_mktsegment")).alias("circ_descrip"),
        F.col("o_orderkey").cast("string").alias("zona_codigo"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("carg_codigo"),
        F.col("l_linenumber").cast("string").alias("ppar_codigo"),
        F.concat(F.lit("Agrupación Nº "), F.col("l_suppkey").cast("string")).alias("ppar_descrip"),
        cant.alias("cant"),
        totins.alias("totins"),
    )
