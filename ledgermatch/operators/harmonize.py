"""Column harmonisation: unified names, numbers, dates, padding, sanitising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch import codes
from ledgermatch.operators.extract import registry_case

# Numbers pandas accepts: optional sign, digits with optional fraction, optional exponent
NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Slashed dates are day-first in these registries, month-first in the others
# (a parameter of the harmonise step); ISO dates and date-times parse anywhere.
DEFAULT_DAY_FIRST = {"verra": False, "gold": True, "acr": False, "car": False}
DATE_FORMATS = ["yyyy-M-d H:m:s", "yyyy-M-d H:m", "yyyy-M-d", "MMM d yyyy"]
GENERIC_DATE_FORMATS = DATE_FORMATS

UNIFIED = ["quantity", "country", "retirement_date", "projectname", "projecttype", "project_id"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_quantity(col) -> Column:
    """Text or number to double; anything pandas would reject becomes 0."""
    text = F.trim(_c(col).cast("string"))
    return (F.when(text.rlike(NUMBER_SHAPE), F.coalesce(text.try_cast("double"), F.lit(0.0)))
            .otherwise(F.lit(0.0)))


def to_year(col) -> Column:
    """Year column to integer; bad text becomes null."""
    c = _c(col)
    return F.when(c.cast("string").rlike(r"^\s*[+-]?\d+(\.0*)?\s*$"),
                  F.trim(c.cast("string")).try_cast("double").cast("int"))


# Rewrites that bring other date texts to the shapes of DATE_FORMATS: a date and time joined by T, a
# fraction of a second, a zone (the wall time is kept), year first with slashes, names of months.
_DATE_REWRITES = [
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
    (r"^(\d{4}-\d{1,2}-\d{1,2})[Tt]", "$1 "),
    (r"^(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}(?::\d{1,2})?)(?:[.,]\d+)?\s*(?:[Zz]|UTC|GMT|[+-]\d{2}:?\d{2})?$", "$1"),
    (r"^(\d{1,2})[ -]([A-Za-z]{3})[a-z]*\.?[ ,-]+(\d{4})$", "$2 $1 $3"),
    (r"^([A-Za-z]{3})[a-z]*\.? +(\d{1,2}),? +(\d{4})$", "$1 $2 $3"),
]
_SHAPES = {
    "yyyy-M-d H:m:s": r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
    "yyyy-M-d H:m": r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}$",
    "yyyy-M-d": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "MMM d yyyy": r"^[A-Z][a-z]{2} \d{1,2} \d{4}$",
}


def parse_timestamp(col, formats: list[str] | None = None, day_first=False) -> Column:
    """Date text to timestamp; bad or null text becomes null.

    Plain ISO dates are parsed at once. ``d/m/yyyy`` (``day_first``) or
    ``m/d/yyyy`` text and the other accepted shapes are rewritten first; then
    each format is tried only on text of its shape, so a non-matching format
    costs a pattern test instead of a failed parse.
    """
    c = F.trim(_c(col).cast("string"))
    formats = formats or DATE_FORMATS
    slashed = r"^(\d{1,2})/(\d{1,2})/(\d{4})"
    if isinstance(day_first, bool):
        text = F.regexp_replace(c, slashed, "$3-$2-$1" if day_first else "$3-$1-$2")
    else:
        text = F.regexp_replace(c, F.lit(slashed), F.when(day_first, "$3-$2-$1").otherwise("$3-$1-$2"))
    for pattern, replacement in _DATE_REWRITES:
        text = F.regexp_replace(text, pattern, replacement)
    # A month's name is looked up as "Jan", whatever its case.
    text = F.initcap(F.lower(text))

    def by_shape(t: Column) -> Column:
        return F.coalesce(*[F.when(t.rlike(_SHAPES[fmt]), F.try_to_timestamp(t, F.lit(fmt))) for fmt in formats])

    # The one-element array binds the rewritten text to a name: it is computed once, and the generated code stays small.
    other = F.get(F.transform(F.array(text), by_shape), F.lit(0))
    return F.when(c.rlike(_SHAPES["yyyy-M-d"]), F.try_to_timestamp(c, F.lit("yyyy-M-d"))).otherwise(other)


def _present(columns: set[str], name: str) -> Column:
    return F.col(f"`{name}`") if name in columns else F.lit(None).cast("string")


def harmonize(df: DataFrame, registry_columns: dict[str, set[str]] | None = None,
              day_first: dict[str, bool] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Registry-specific columns to the unified names, per the registry of each row.

    A unified column already present in an export wins over the rename, like the
    per-file rename that skips a target that exists. Quantity becomes a double
    (bad -> 0), the retirement date a timestamp (bad -> null) with its year, and
    vintage the year of ``Vintage Start`` or else the ``Vintage`` text.

    Cheap CASEs over the registry pick each source column; every parse then runs
    once per row. One projection: the raw export columns are dropped unless
    listed in ``keep`` (``None`` keeps every column).
    """
    first = {**DEFAULT_DAY_FIRST, **(day_first or {})}

    def pick(target):
        def build(reg, cols):
            if target in cols:
                return _present(cols, target).cast("string")
            sources = [s for s, t in codes.COLUMN_RENAMES[reg].items() if t == target and s in cols]
            return _present(cols, sources[0]).cast("string") if sources else F.lit(None).cast("string")
        return registry_case(df, registry_columns, build)

    def vintage_source(reg, cols):
        if "vintage" in cols:
            return F.struct(F.col("vintage").cast("string").alias("text"), F.lit(False).alias("is_date"))
        if codes.VINTAGE_START in cols:
            return F.struct(_present(cols, codes.VINTAGE_START).cast("string").alias("text"),
                            F.lit(True).alias("is_date"))
        if codes.VINTAGE in cols:
            return F.struct(_present(cols, codes.VINTAGE).cast("string").alias("text"),
                            F.lit(False).alias("is_date"))
        return F.struct(F.lit(None).cast("string").alias("text"), F.lit(False).alias("is_date"))

    day_first_col = registry_case(df, registry_columns, lambda reg, cols: F.lit(first.get(reg, False)))
    staged = df.select(
        "*",
        pick("quantity").alias("__quantity"), pick("country").alias("__country"),
        pick("retirement_date").alias("__date"), pick("projectname").alias("__projectname"),
        pick("projecttype").alias("__projecttype"), pick("project_id").alias("__project_id"),
        registry_case(df, registry_columns, vintage_source).alias("__vintage"),
        day_first_col.alias("__day_first"))
    retirement_date = parse_timestamp(F.col("__date"), day_first=F.col("__day_first"))
    vintage_year = F.year(parse_timestamp(F.col("__vintage.text"), day_first=F.col("__day_first")))
    unified = {
        "quantity": to_quantity(F.col("__quantity")),
        "country": F.col("__country"),
        "retirement_date": retirement_date,
        "projectname": F.col("__projectname"),
        "projecttype": F.col("__projecttype"),
        "project_id": F.col("__project_id"),
        "vintage": F.when(F.col("__vintage.is_date"), vintage_year.cast("string"))
                    .otherwise(F.col("__vintage.text")),
    }
    # Spark resolves names case-insensitively: an export column such as
    # "Quantity" would clash with the unified "quantity", so it is not kept
    lower = {k.lower() for k in unified} | {"retirement_year"}
    kept = [c for c in df.columns if c.lower() not in lower and (keep is None or c in keep)]
    out = staged.select(*[F.col(f"`{c}`") for c in kept], *[v.alias(k) for k, v in unified.items()])
    return out.withColumn("retirement_year", F.year("retirement_date"))


def registry_serial(df: DataFrame, registry_columns: dict[str, set[str]] | None = None) -> Column:
    """Serial number as text, from each registry's own serial column (null if absent)."""
    def build(reg, cols):
        name = codes.SERIAL_COLUMN[reg]
        return _present(cols, name).cast("string")
    return registry_case(df, registry_columns, build)


# ---------------------------------------------------------------- base dataset

def prepare_base(base: DataFrame) -> DataFrame:
    """Earlier matched rows in the unified shape (renames, year, registry, defaults)."""
    cols = set(base.columns)
    renames = {k: v for k, v in codes.BASE_RENAMES.items() if k in cols}
    out = base.withColumnsRenamed(renames) if renames else base
    cols = set(out.columns)
    if "retirement_year" not in cols:
        if "ret_date" in cols:
            out = out.withColumn("retirement_date",
                                 parse_timestamp(F.col("ret_date"), GENERIC_DATE_FORMATS))
            out = out.withColumn("retirement_year", F.year("retirement_date"))
        elif "year" in cols:
            out = out.withColumn("retirement_year", F.col("year"))
    if "registry" in cols:
        out = out.replace(codes.BASE_REGISTRY_VALUES, subset=["registry"])
    has_id = F.coalesce(F.col("factset_entity_id") != "", F.lit(False))
    if "match_confidence" not in cols:
        out = out.withColumn("match_confidence", F.when(has_id, "high").otherwise("none"))
    if "match_method" not in cols:
        out = out.withColumn("match_method", F.when(has_id, "original").otherwise("unmatched"))
    return out


# ---------------------------------------------------------------- output shape

OUTPUT_TYPES = {
    "retirement_year": T.IntegerType(),
    "quantity": T.DoubleType(),
}


def project_output(df: DataFrame, extra: list[str] | tuple = ()) -> DataFrame:
    """The fixed 14 columns (absent ones padded with ``""``, then typed), plus ``extra``."""
    cols = []
    for name in codes.OUTPUT_COLUMNS:
        c = F.col(name) if name in df.columns else F.lit("")
        if name == "quantity":
            c = to_quantity(c)
        elif name == "retirement_year":
            c = to_year(c)
        else:
            c = c.cast("string")
        cols.append(c.alias(name))
    return df.select(*cols, *extra)


def sanitize(df: DataFrame) -> DataFrame:
    """Every string column: null, exact ``nan`` or ``None`` -> ``""``."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            c = F.when(c.isNull() | c.isin("nan", "None"), F.lit("")).otherwise(c)
        out.append(c.alias(field.name))
    return df.select(*out)

