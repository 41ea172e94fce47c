"""Company documents and JSON lists.

A company profile arrives as one JSON document per requested symbol. It is parsed once, as
a variant; unknown keys are ignored. A malformed or missing document does not fail the
batch but becomes an error row ``(symbol, ingested_at, error)`` that is kept, exactly like
a failed fetch. A number may be written in any form (``5``, ``5.0``, ``5e0``, ``"5"``); a
field that cannot be read as its type is NULL and named in ``error``, beside the fields that
can.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.schemas import COMPANY_DOC_FIELDS

MALFORMED = "malformed company document"
MISSING = "missing company document"
UNREADABLE = "unreadable fields: "


def _typed(value: Column, dtype: T.DataType) -> Column:
    """A variant as the field's type, NULL if it isn't one: no fraction is cut off a whole
    number, and a number is finite."""
    if isinstance(dtype, T.StringType):
        return F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    sound = ~F.isnan(number) & (F.abs(number) < float("inf"))
    if isinstance(dtype, T.DoubleType):
        return F.when(sound, number)
    whole = F.coalesce(F.try_variant_get(value, "$", dtype.simpleString()),
                       number.try_cast(dtype.simpleString()))
    return F.when(sound & (F.floor(number).cast("double") == number), whole)


def company_from_json(df: DataFrame, symbol_col: str = "symbol", doc_col: str = "doc",
                      ingested_col: str = "ingested_at") -> DataFrame:
    """Project the 22 company fields out of each document, renamed to snake_case.

    ``company_name`` falls back longName -> shortName -> symbol on key *absence*; an
    explicit ``"longName": null`` stays NULL (S12). Bad documents and unreadable fields give
    an error (S13).
    """
    doc = F.col(doc_col)
    # the parse and each field's variant stand in projections of their own, so that nothing
    # is parsed twice
    parsed = df.select(
        F.col(symbol_col).alias("symbol"), F.col(ingested_col).alias("ingested_at"),
        doc.isNull().alias("_missing"),
        F.try_variant_get(F.try_parse_json(doc), "$", "map<string,variant>").alias("_doc"))
    keys = ["longName", "shortName", *[key for key, _, _ in COMPANY_DOC_FIELDS]]
    raw = parsed.select("symbol", "ingested_at", "_missing", F.col("_doc").isNotNull().alias("_ok"),
                        *[F.col("_doc")[k].alias(f"_{k}") for k in keys])
    typed = raw.select(
        "*", *[_typed(F.col(f"_{key}"), dtype).alias(column)
               for key, column, dtype in COMPANY_DOC_FIELDS])
    bad = F.array_compact(F.array(*[
        F.when(F.col(f"_{key}").isNotNull() & ~F.is_variant_null(f"_{key}")
               & F.col(column).isNull(), F.lit(key)) for key, column, _ in COMPANY_DOC_FIELDS]))
    text = lambda k: F.try_variant_get(f"_{k}", "$", "string")
    name = (F.when(F.col("_longName").isNotNull(), text("longName"))
             .when(F.col("_shortName").isNotNull(), text("shortName"))
             .otherwise(F.col("symbol").cast("string")))
    error = (F.when(F.col("_missing"), F.lit(MISSING)).when(~F.col("_ok"), F.lit(MALFORMED))
             .when(F.size(bad) > 0, F.concat(F.lit(UNREADABLE), F.array_join(bad, ", "))))
    return typed.select(
        "symbol", F.when(F.col("_ok"), name).alias("company_name"),
        *[column for _, column, _ in COMPANY_DOC_FIELDS], "ingested_at", error.alias("error"))


def company_records(good: DataFrame, errors: DataFrame) -> DataFrame:
    """Ragged union of complete records and error-only records (U3): columns missing on
    either side are filled with NULL."""
    return good.unionByName(errors, allowMissingColumns=True)


MESSAGE_SCHEMA = T.ArrayType(T.StructType([T.StructField("craft", T.StringType()),
                                           T.StructField("name", T.StringType())]))
# The message template of the list fan-out and its default greeting.
MESSAGE_TEMPLATE = "%s is currently in space flying on the %s! %s"
DEFAULT_GREETING = "Hello! :)"


def explode_messages(df: DataFrame, list_col: str, greeting: str = DEFAULT_GREETING,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """A JSON list of ``{craft, name}`` -> one formatted line per element.

    A missing value prints as ``None``, as the Python f-string of the reference does.
    """
    items = F.from_json(F.col(list_col), MESSAGE_SCHEMA)
    exploded = df.select(*keep, F.posexplode(items).alias("pos", "item"))
    shown = lambda c: F.coalesce(F.col(c), F.lit("None"))
    return exploded.select(*keep, "pos", F.format_string(
        MESSAGE_TEMPLATE, shown("item.name"), shown("item.craft"), F.lit(greeting)
    ).alias("message"))
