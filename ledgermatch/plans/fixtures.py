"""Registry-shaped inputs derived by Spark from the driver's tables.

The reference ships no input data, so the four registry exports, the base of
earlier matched rows and the firm universe are derived from the TPC-H-style
tables: one ledger row per ``lineitem`` row (so the work grows with the data),
registry from ``l_suppkey % 4``, beneficiary text from the customer name with a
pattern chosen by ``l_linenumber``. Row order for first/last-wins rules is the
bigint ``seq``, the place of a row by (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.operators.numbering import in_key_ranges, key_bounds, number_ranges
from ledgermatch.session import scratch_path

# FIXED VALUES of the fixture design (not of the reference)
FIXTURE_REGISTRIES = ["verra", "gold", "acr", "car"]
FIXTURE_COUNTRIES = [
    "Brazil", "India", "China", "United States", "Indonesia", "Kenya", "Vietnam", "Viet Nam",
    "Korea, Republic of", "Colombia", "Peru", "Turkey", "Congo, The Democratic Republic of The",
    "Mexico", "Chile", "Cambodia", "Zimbabwe", "Uganda", "Lao People's Democratic Republic",
    "Tanzania, United Republic of", "Ghana", "Thailand", "Guatemala", "Atlantis", "United Kingdom",
]
FIXTURE_ISO3 = [
    "BRA", "IND", "CHN", "USA", "IDN", "KEN", "VNM", "VNM", "KOR", "COL", "PER", "TUR", "COD",
    "MEX", "CHL", "KHM", "ZWE", "UGA", "LAO", "TZA", "GHA", "THA", "GTM", "", "GBR",
]
FIXTURE_ISO2 = [
    "US", "BR", "DE", "GB", "AU", "JP", "FR", "CH", "CN", "CO", "KR", "IN", "IT",
    "CA", "ES", "NL", "SE", "NO", "CY", "CD", "MX", "CL", "ZA", "SG", "HK",
]
FIXTURE_KEYWORDS = ["REDD+", "Wind", "Landfill gas", "Soil carbon", "Energy efficiency",
                    "Industrial gas", "HFC-23", "Fleet", "CCS", "Cement", "Hydro", "x"]

REGISTRY_COLUMNS = {
    "verra": {"Serial Number", "Retirement Beneficiary", "Retirement Details", "Quantity Issued",
              "Country/Area", "Retirement/Cancellation Date", "Name", "Project Type", "ID",
              "Vintage Start"},
    "gold": {"Serial Number", "* Using Entity", "Using Entity", "Note", "Quantity", "Country",
             "Retirement Date", "Project Name", "Project Type", "GSID", "Vintage Start"},
    "acr": {"Credit Serial Numbers", "Retired on Behalf of", "Account Holder", "Quantity of Credits",
            "Project Site Country", "Status Effective (GMT)", "Project Name", "Project Type",
            "Project ID", "Vintage"},
    "car": {"Offset Credit Serial Numbers", "Account Holder", "Retirement Reason Details",
            "Quantity of Offset Credits", "Project Site Country", "Status Effective", "Project Name",
            "Project Type", "Project ID", "Vintage"},
}

DATE_VARIANTS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss'.123'", "yyyy/MM/dd",
                 "MMM d, yyyy", "d MMM yyyy", "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"]
DATE_PATTERNS = {"verra": "yyyy-MM-dd", "gold": "dd/MM/yyyy", "acr": "yyyy-MM-dd HH:mm:ss",
                 "car": "MM/dd/yyyy"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _reg_case(mapping: dict[str, Column]) -> Column:
    expr = None
    for reg, value in mapping.items():
        cond = F.col("registry_key") == reg
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr


def joined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order, customer, part and supplier: plain columns only, the texts are derived when read.

    Orders meet their customers first, so that the line items are shuffled for two joins at most. The last one deals line
    items and orders by ranges of order keys, in which the rows are numbered as they lie.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    bounds = key_bounds(od, "o_orderkey")
    placed = od.join(cu, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey")
    lines = (li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")
             .join(pa, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey"))
    lines, placed = in_key_ranges(lines, "l_orderkey", bounds), in_key_ranges(placed, "o_orderkey", bounds)
    same = (lines["_range"] == placed["_range"]) & (F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.join(placed, same).drop(placed["_range"]).drop("o_orderkey")


def derived_rows(joined: DataFrame) -> DataFrame:
    """The joined rows with their derived text; ``seq`` stays."""
    ln = F.col("l_linenumber")
    n = F.replace(F.col("c_name"), F.lit("Customer"), F.lit("Client"))
    qty = (F.col("l_quantity") * 1000).cast("long").cast("string")
    return joined.select(
        "l_partkey", "l_suppkey",
        _pick(FIXTURE_REGISTRIES, F.col("l_suppkey") % 4).alias("registry_key"),
        "l_orderkey", "l_linenumber", "l_shipdate", "c_custkey", "s_nationkey",
        n.alias("n"),
        F.when(F.col("l_orderkey") % 53 != 0,
               F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("serial"),
        (F.when(ln == 1, n)
         .when(ln == 2, F.concat(F.upper(n), F.lit(" Inc.")))
         .when(ln == 3, F.concat(F.lit("  "), n, F.lit(" Holdings,  Ltd ")))
         .when(ln == 4, F.concat(n, F.lit(" - 1234567")))
         .when(ln == 6, F.concat(n, F.lit(" 12.345.678/0001-90 x@y.com")))).alias("primary_name"),
        (F.when(ln == 5, F.concat(F.lit("Retired on behalf of "), n, F.lit("; for "), F.col("p_name")))
         .when(ln == 7, F.concat(F.lit("Retired by XYZ for "), F.col("p_name")))).alias("details"),
        (F.when(ln == 7, F.lit("n/a"))
         .when(ln == 3, F.concat(F.lit(" "), qty, F.lit(" ")))
         .when(ln == 6, F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit("e3")))
         .otherwise(qty)).alias("qty_text"),
        (F.col("l_quantity") * 1000).alias("quantity_value"),
        F.col("p_name").alias("projectname"),
        F.when(F.col("l_partkey") % 25 != 0,
               F.concat(F.col("p_type"), F.lit(" "), _pick(FIXTURE_KEYWORDS, F.col("l_partkey") % 12))
               ).alias("projecttype"),
        F.col("l_partkey").cast("string").alias("project_id"),
        _pick(FIXTURE_COUNTRIES, F.col("s_nationkey")).alias("country"),
        _pick(FIXTURE_ISO3, F.col("s_nationkey")).alias("iso3"),
        "o_orderdate", "seq",
    )


def ledger_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed raw ledger: the four registry exports' columns, null where an export lacks one."""
    r = ledger_rows(spark, sf_dir)
    reg = F.col("registry_key")
    ln = F.col("l_linenumber")
    # the registry's own pattern, and on some rows the other shapes that exports hold
    variant = F.lit(None).cast("string")
    for k, pattern in enumerate(DATE_VARIANTS):
        variant = F.when(F.col("l_orderkey") % 17 == k, F.date_format("l_shipdate", pattern)).otherwise(variant)
    own = _reg_case({k: F.date_format("l_shipdate", v) for k, v in DATE_PATTERNS.items()})
    date_text = F.when(F.col("l_orderkey") % 101 == 0, F.lit("not a date")).otherwise(F.coalesce(variant, own))
    vintage_start = F.date_format("o_orderdate", "yyyy-MM-dd")
    vintage = F.year("o_orderdate").cast("string")
    only = lambda regs, value: F.when(reg.isin(regs), value)
    return r.select(
        "seq", "registry_key",
        only(["verra", "gold"], F.col("serial")).alias("Serial Number"),
        only(["acr"], F.col("serial")).alias("Credit Serial Numbers"),
        only(["car"], F.col("serial")).alias("Offset Credit Serial Numbers"),
        only(["verra"], F.col("primary_name")).alias("Retirement Beneficiary"),
        only(["verra"], F.col("details")).alias("Retirement Details"),
        only(["gold"], F.when(ln == 3, F.lit("")).otherwise(F.col("primary_name"))).alias("* Using Entity"),
        only(["gold"], F.when(ln == 3, F.col("primary_name")).when(ln == 5, F.lit("Fallback Holdings"))
             ).alias("Using Entity"),
        only(["gold"], F.col("details")).alias("Note"),
        only(["acr"], F.col("primary_name")).alias("Retired on Behalf of"),
        F.when(reg == "acr", F.when(ln == 5, F.concat(F.col("n"), F.lit(" Account"))))
         .when(reg == "car", F.col("primary_name")).alias("Account Holder"),
        only(["car"], F.col("details")).alias("Retirement Reason Details"),
        only(["verra"], F.col("qty_text")).alias("Quantity Issued"),
        only(["gold"], F.col("qty_text")).alias("Quantity"),
        only(["acr"], F.col("qty_text")).alias("Quantity of Credits"),
        only(["car"], F.col("qty_text")).alias("Quantity of Offset Credits"),
        only(["verra"], F.col("country")).alias("Country/Area"),
        only(["gold"], F.col("country")).alias("Country"),
        only(["acr", "car"], F.col("country")).alias("Project Site Country"),
        only(["verra"], date_text).alias("Retirement/Cancellation Date"),
        only(["gold"], date_text).alias("Retirement Date"),
        only(["acr"], date_text).alias("Status Effective (GMT)"),
        only(["car"], date_text).alias("Status Effective"),
        only(["verra"], F.col("projectname")).alias("Name"),
        only(["gold", "acr", "car"], F.col("projectname")).alias("Project Name"),
        F.col("projecttype").alias("Project Type"),
        only(["verra"], F.col("project_id")).alias("ID"),
        only(["gold"], F.col("project_id")).alias("GSID"),
        only(["acr", "car"], F.col("project_id")).alias("Project ID"),
        only(["verra", "gold"], vintage_start).alias("Vintage Start"),
        only(["acr", "car"], vintage).alias("Vintage"),
    )


def base_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier matched rows (ship year <= 2000) in the base shape."""
    r = ledger_rows(spark, sf_dir).filter(F.year("l_shipdate") <= 2000)
    ln = F.col("l_linenumber")
    ck = F.col("c_custkey")
    n = F.col("n")
    fid = (F.when(ck % 3 == 0,
                  F.when(ln == 4, F.concat(F.lit("E"), ((ck + 1) % 50).cast("string")))
                  .otherwise(F.concat(F.lit("E"), (ck % 50).cast("string"))))
           .when(ck % 7 == 0, F.lit(None).cast("string"))
           .otherwise(F.lit("")))
    official = F.when(F.coalesce(fid != "", F.lit(False)) & ~((ln == 1) & (F.col("l_orderkey") % 5 == 0)),
                      F.concat(F.lit("Firm "), F.substring(fid, 2, 100)))
    reg = F.col("registry_key")
    even = F.col("l_orderkey") % 2 == 0
    label = (F.when(reg == "verra", F.when(even, "Verra").otherwise("verra"))
             .when(reg == "gold", F.when(even, "Gold").otherwise("gold"))
             .when(reg == "acr", F.lit("Acr")).otherwise(F.lit("Car")))
    company = (F.when(ln == 1, n).when(ln == 2, F.concat(F.upper(n), F.lit(" Inc.")))
               .when(ln == 3, F.concat(n, F.lit(" Holdings, Ltd"))).when(ln.isin(4, 5), n)
               .when(ln == 6, F.concat(n, F.lit(" S.A."))))
    return r.select(
        "seq",
        company.alias("company"),
        official.alias("official_name"),
        fid.alias("factset_entity_id"),
        label.alias("registry"),
        F.when(F.col("l_orderkey") % 101 == 0, F.lit("n/a"))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ret_date"),
        F.col("serial").alias("serialnumber"),
        F.col("quantity_value").alias("quantity"),
        "country", "projectname", "projecttype",
        F.year("o_orderdate").cast("string").alias("vintage"),
        F.when(F.col("s_nationkey") % 3 == 0, F.lit("")).otherwise(F.col("iso3")).alias("isocode"),
    )


def entity_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firm universe source: one entity per customer; ids E0..E49 repeated once (E0..E4)."""
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    n = F.replace(F.col("c_name"), F.lit("Customer"), F.lit("Client"))
    fid = (F.when(ck < 50, F.concat(F.lit("E"), ck.cast("string")))
           .when(ck < 55, F.concat(F.lit("E"), (ck - 50).cast("string")))
           .otherwise(F.concat(F.lit("X"), ck.cast("string"))))
    iso2 = _pick(FIXTURE_ISO2, F.when(ck.between(50, 54), (F.col("c_nationkey") + 1) % 25)
                 .otherwise(F.col("c_nationkey")))
    return c.select(
        fid.alias("factset_entity_id"),
        F.upper(n).alias("entity_name"),
        F.concat(n, F.lit(" Corp")).alias("entity_proper_name"),
        F.when((ck % 5 == 0) & (ck >= 5), F.lit("PRI")).otherwise(F.lit("PUB")).alias("entity_type"),
        iso2.alias("iso_country"),
        (ck % 7).cast("string").alias("sector_code"),
        (ck % 11).cast("string").alias("industry_code"),
        (ck % 13).cast("string").alias("primary_sic_code"),
        ck.alias("seq"),
    )


def entity_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISIN for even customers, LEI for multiples of 3, OTHER for all, a second ISIN for multiples of 4."""
    c = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    fid = (F.when(ck < 50, F.concat(F.lit("E"), ck.cast("string")))
           .when(ck < 55, F.concat(F.lit("E"), (ck - 50).cast("string")))
           .otherwise(F.concat(F.lit("X"), ck.cast("string"))))

    def ident(kind: str, value: Column, k: int, keep: Column) -> Column:
        return F.when(keep, F.struct(F.lit(kind).alias("entity_id_type"), value.alias("entity_id_value"),
                                     (ck * 10 + k).alias("seq")))

    items = F.array(
        ident("ISIN", F.concat(F.lit("ISIN"), ck.cast("string")), 0, ck % 2 == 0),
        ident("LEI", F.concat(F.lit("LEI"), ck.cast("string")), 1, ck % 3 == 0),
        ident("OTHER", F.concat(F.lit("OTH"), ck.cast("string")), 2, F.lit(True)),
        ident("ISIN", F.concat(F.lit("ISIN2-"), ck.cast("string")), 3, ck % 4 == 0),
    )
    return (c.select(fid.alias("factset_entity_id"), F.explode(items).alias("_i"))
            .filter(F.col("_i").isNotNull())
            .select("factset_entity_id", "_i.entity_id_type", "_i.entity_id_value", "_i.seq"))


# ------------------------------------------------------------------ landing

_LANDED: dict[tuple[str, str, str], str] = {}
_NUMBERED: dict[tuple[str, str], DataFrame] = {}


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived rows with their order key, as ingestion numbers them; numbered once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _NUMBERED:
        order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity") * 1000, "l_shipdate"]
        _NUMBERED[key] = number_ranges(joined_rows(spark, sf_dir), order)
    return derived_rows(_NUMBERED[key])


BUILDERS = {
    "ledger_raw": ledger_raw,
    "base": base_dataset,
    "entity_coverage": entity_coverage,
    "entity_identifiers": entity_identifiers,
}

#: Made from the numbered rows, which lie in many files already: these wide rows are written without a shuffle.
FROM_LEDGER_ROWS = {"ledger_raw", "base"}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input written once per session as Parquet, then read like a landed export.

    The registry exports are files in a real run; writing the derived ones keeps
    the operators' plans the same as over real files (plain columns, pushdown)
    and is done once per session and scale. The folder is the shared
    checkpoint folder of the session (``spark.checkpoint.dir``).
    """
    return spark.read.parquet(landed_path(spark, sf_dir, name))


def landed_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of a derived input, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _LANDED:
        path = scratch_path(spark, f"landed-{name}")
        frame = BUILDERS[name](spark, sf_dir)
        if name not in FROM_LEDGER_ROWS:
            # spread the landed export over as many files as there are task slots
            frame = frame.repartition(spark.sparkContext.defaultParallelism)
        frame.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        _LANDED[key] = path
    return _LANDED[key]


def registry_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "ledger_raw")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "base")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "entity_coverage")


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "entity_identifiers")
