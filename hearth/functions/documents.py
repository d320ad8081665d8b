"""JSON documents as variants: typed fields by path, several names for one field, and malformed documents set apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions.parse import html_text

# Field of a listing, the names it may have in an advertisement document (the first that holds a value counts), its type.
AD_FIELDS = (
    ("listing", "list_id", "string"), ("title", "subject", "string"), ("description", "body", "string"), ("price", "price_string price", "string"), ("area", "size", "string"),
    ("price_per_m2", "price_million_per_m2", "string"), ("bedroom", "rooms", "string"), ("bathroom", "toilets", "string"), ("floor_count", "floors", "string"),
    ("latitude", "latitude", "string"), ("longitude", "longitude", "string"), ("legal_status", "property_legal_document", "string"), ("house_direction", "direction", "string"),
    ("interior", "furnishing_sell", "string"), ("house_type", "house_type", "string"), ("living_size", "living_size", "string"), ("width", "width", "string"), ("length", "length", "string"),
    ("street", "street_name", "string"), ("ward", "ward_name", "string"), ("district", "area_name", "string"), ("province", "region_name", "string"),
    ("seller_name", "account_name", "string"), ("seller_account", "account_id", "string"), ("list_time", "list_time", "double"),
)


def field(document: Column, path: str, kind: str) -> Column:
    """The value at a path, null where it is absent or of another kind."""
    return F.try_variant_get(document, path, kind)


def with_documents(rows: DataFrame, text: str, name: str = "document") -> DataFrame:
    """``name``, the parsed text, and ``malformed``: whether there is a text that is no JSON.  A null text is no document and not malformed."""
    return rows.withColumn(name, F.try_parse_json(text)).withColumn("malformed", F.col(text).isNotNull() & F.col(name).isNull())


def split_malformed(rows: DataFrame, text: str, name: str = "document") -> tuple[DataFrame, DataFrame]:
    """Rows with a parsed document, and the quarantine: rows whose text cannot be read, as they came."""
    read = with_documents(rows, text, name)
    return read.where(~F.col("malformed")).drop("malformed"), read.where("malformed").drop("malformed", name)


def advertisement_record(ad: Column, url: Column | None = None) -> dict[str, Column]:
    """All fields of a listing from an advertisement (a variant)."""
    found = {name: F.coalesce(*[F.nullif(field(ad, f"$.{n}", kind), F.lit("")) if kind == "string" else field(ad, f"$.{n}", kind) for n in names.split()]) for name, names, kind in AD_FIELDS}
    places = [found[p] for p in ("street", "ward", "district", "province")]
    made = F.concat(F.lit("https://ads.example/"), found["listing"], F.lit(".htm"))
    return {n: c for n, c in found.items() if n not in ("description", "list_time")} | {
        "description": html_text(found["description"]),
        "location": F.nullif(F.concat_ws(", ", *places), F.lit("")),
        "url": made if url is None else F.coalesce(url, made),
        "posted": F.floor(found["list_time"] / 1000).cast("long"),
    }
