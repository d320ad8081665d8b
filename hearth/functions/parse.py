"""Text to value: numbers in local notation, prices with units, codes, types, addresses.

All functions are column expressions.  Unparsable text gives null (``try_cast``), never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN, UNKNOWN_ID = "unknown", -1

# The codes of the two sources.
DIRECTIONS = {1: "Đông", 2: "Tây", 3: "Nam", 4: "Bắc", 5: "Đông Bắc", 6: "Đông Nam", 7: "Tây Bắc", 8: "Tây Nam"}
LEGAL = {1: "Đã có sổ", 2: "Đang chờ sổ", 4: "Không có sổ", 5: "Sổ chung / Vi bằng", 6: "Giấy tờ viết tay"}
INTERIOR = {1: "Cao cấp", 2: "Đầy đủ", 3: "Cơ bản", 4: "Bàn giao thô"}
HOUSE_TYPES = {1: "Nhà mặt phố / Mặt tiền", 2: "Biệt thự", 3: "Nhà trong ngõ / hẻm", 4: "Nhà phố liền kề"}

# Key words of the free-text classes, tried in this order.
LEGAL_WORDS = (
    (1, "sổ đỏ|sổ hồng|có sổ|đã có sổ|shr|shcc|sđcc|sdcc|bìa đỏ"),
    (2, "đang chờ sổ|chờ sổ|làm sổ"),
    (4, "không pháp lý|ko sổ|không"),
    (5, "hợp đồng mua bán|hđmb|vi bằng|vbcn|giấy tay|giấy tờ viết tay|sổ chung"),
)
INTERIOR_WORDS = (
    (1, "cao cấp|sang trọng|xịn|luxury|5 sao|nhập khẩu"),
    (4, "không nội thất|nhà thô|bàn giao thô|thô|giao thô"),
    (3, "cơ bản|nội thất cơ bản|một số nội thất|điều hòa|tủ lạnh|giường|tủ"),
)
TYPE_NAMES = (
    ("house", ("house", "nhà", "nhà ở", "biệt thự", "villa", "nhà riêng", "nhà phố")),
    ("apartment", ("apartment", "chung cư", "căn hộ", "penthouse", "duplex")),
    ("land", ("land", "đất", "đất nền", "đất thổ cư")),
    ("commercial", ("commercial", "văn phòng", "cửa hàng", "shophouse", "mặt bằng")),
)
TYPE_WORDS = (
    ("house", ("nhà", "biệt thự", "villa", "nhà phố", "nhà riêng", "townhouse")),
    ("apartment", ("chung cư", "căn hộ", "penthouse", "duplex", "apartment")),
    ("land", ("đất", "đất nền", "thổ cư", "lô đất", "nền đất")),
    ("commercial", ("văn phòng", "cửa hàng", "shophouse", "mặt bằng", "kinh doanh", "thương mại")),
)
# Administrative prefixes removed from lookup keys.
PREFIXES = {
    "province": ("tỉnh", "thành phố", r"tp\.", "tp"),
    "district": ("quận", "huyện", "thị xã", "thành phố"),
    "ward": ("phường", "xã", "thị trấn"),
}


def local_number(text: Column) -> Column:
    """``1.200,5 m²`` -> 1200.5: dots group, a comma is the decimal point; a unit ``m2`` goes first."""
    plain = F.regexp_replace(F.lower(text), r"m2(?![0-9])", "")
    swapped = F.regexp_replace(F.regexp_replace(plain, r"\.", ""), ",", ".")
    return F.regexp_replace(swapped, r"[^0-9.]", "").try_cast("double")


def plain_number(text: Column) -> Column:
    """Keeps dots (the second source's notation)."""
    return F.regexp_replace(text, r"[^0-9.]", "").try_cast("double")


def digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "").try_cast("double")


def negotiable(text: Column) -> Column:
    return F.coalesce(F.lower(text).contains("thỏa thuận"), F.lit(False))


def invalid_unit(text: Column) -> Column:
    """Thousands of the currency are no plausible total."""
    low = F.lower(F.trim(text))
    return F.coalesce(low.contains("nghìn") | low.contains("k ") | low.rlike("[0-9]+k$"), F.lit(False))


def unit_price(text: Column) -> Column:
    """``5,2 tỷ`` -> 5.2e9, ``850 triệu`` -> 8.5e8, no unit: as it is; negotiable: null."""
    low = F.lower(text)
    n = local_number(text)
    billions = low.contains("tỷ") | low.rlike(r"(^|[^a-z])ty([^a-z]|$)")
    millions = low.contains("triệu") | low.contains("trieu")
    return F.when(~negotiable(text), F.when(billions, n * 1e9).when(millions, n * 1e6).otherwise(n))


def per_area(text: Column) -> Column:
    return F.coalesce(F.lower(text).rlike("/m(²|2)"), F.lit(False))


def unswapped(price: Column, per_m2: Column) -> tuple[Column, Column]:
    """The two texts in their right order: a price by area in the price field and a total in the other are exchanged."""
    total = F.coalesce(F.lower(per_m2).rlike("tỷ|triệu") & ~per_area(per_m2), F.lit(False))
    wrong = per_area(price) & total
    return F.when(wrong, per_m2).otherwise(price), F.when(wrong, price).otherwise(per_m2)


def per_m2_or_derived(per_m2: Column, price: Column, area: Column) -> Column:
    return F.coalesce(unit_price(per_m2), F.round(F.try_divide(price, F.nullif(area, F.lit(0.0))), 2))


def coordinate(value: Column, low: float, high: float) -> Column:
    return F.when(value.between(low, high), value)


def latitude(value: Column) -> Column:
    return coordinate(value, 8.0, 23.5)


def longitude(value: Column) -> Column:
    return coordinate(value, 102.0, 110.0)


def timestamp(text: Column) -> Column:
    """Epoch seconds or a date text; null where neither."""
    return F.coalesce(F.timestamp_seconds(text.try_cast("bigint")), F.try_to_timestamp(text))


def day_month_year(text: Column) -> Column:
    """``dd/mm/yyyy`` as epoch seconds."""
    return F.unix_timestamp(F.try_to_timestamp(text, F.lit("dd/MM/yyyy")))


def _code(text: Column, names: dict[int, str]) -> Column:
    chain = F.lit(UNKNOWN_ID)
    for code, name in names.items():
        chain = F.when(text == name, code).otherwise(chain)
    return chain


def decode(code: Column, names: dict[int, str]) -> tuple[Column, Column]:
    """(text, code) of a code given as text or number; both unknown where it is not listed."""
    n = code.try_cast("int")
    text = F.lit(UNKNOWN)
    for value, name in names.items():
        text = F.when(n == value, name).otherwise(text)
    return text, F.when(text != UNKNOWN, n).otherwise(UNKNOWN_ID)


def direction(text: Column) -> tuple[Column, Column]:
    low = F.lower(F.trim(text))
    east, west, south, north = (low.rlike(f"(^|[\\s-])({w})([\\s-]|$)") for w in ("đông|dong", "tây|tay", "nam", "bắc|bac"))
    name = (
        F.when(east & north, "Đông Bắc").when(east & south, "Đông Nam").when(west & north, "Tây Bắc").when(west & south, "Tây Nam")
        .when(east, "Đông").when(west, "Tây").when(south, "Nam").when(north, "Bắc").otherwise(UNKNOWN)
    )
    return name, _code(name, DIRECTIONS)


def legal_status(text: Column) -> tuple[Column, Column]:
    low = F.lower(F.trim(text))
    name = F.lit(UNKNOWN)
    for code, words in reversed(LEGAL_WORDS):
        name = F.when(low.rlike(words), LEGAL[code]).otherwise(name)
    return name, _code(name, LEGAL)


def interior(text: Column) -> tuple[Column, Column]:
    """Any other text than ``k`` means furnished."""
    low = F.lower(F.trim(text))
    name = F.when((low != "") & (low != "k"), INTERIOR[2]).otherwise(UNKNOWN)
    for code, words in reversed(INTERIOR_WORDS):
        name = F.when(low.rlike(words), INTERIOR[code]).otherwise(name)
    return name, _code(name, INTERIOR)


def property_type(data_type: Column, *texts: Column) -> Column:
    """By the name of the type where there is one, else by key words of the texts, else a house."""
    low = F.lower(data_type)
    named = F.lit("other")
    for kind, names in reversed(TYPE_NAMES):
        named = F.when(low.isin(*names), kind).otherwise(named)
    content = F.lower(F.concat_ws(" ", *texts)) if texts else F.lit("")
    found = F.lit("house")
    for kind, words in reversed(TYPE_WORDS):
        found = F.when(content.rlike("|".join(words)), kind).otherwise(found)
    return F.when(data_type.isNotNull(), named).otherwise(found)


def derived_type(data_type: Column, bedroom: Column, area: Column) -> Column:
    return F.when(F.nullif(data_type, F.lit("")).isNotNull(), F.upper(data_type)).when(bedroom > 0, "HOUSE").when(area > 0, "LAND").otherwise("UNKNOWN")


def url_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/([0-9]+)(?:\.htm)?$", 1), F.lit(""))


def joined(*parts: Column) -> Column:
    """Non-empty parts, comma-joined."""
    return F.concat_ws(", ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def key_text(text: Column) -> Column:
    """Lower case without spaces, hyphens and underscores."""
    return F.translate(F.lower(F.trim(F.coalesce(text, F.lit("")))), " -_", "")


def html_text(html: Column) -> Column:
    """Markup to text: script and style bodies and tags go, the common entities are resolved, white space is one blank."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), r"(?s)<!--.*?-->|<[^>]*>", " ")
    # Entities, the ampersand last.
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"[ \t\r\n\f]+", " "))


def map_coordinates(url: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a map frame's ``q=lat,lng``."""
    pattern = r"[?&]q=([-0-9.]+),([-0-9.]+)"
    return F.regexp_extract(url, pattern, 1).try_cast("double"), F.regexp_extract(url, pattern, 2).try_cast("double")


def snake_label(label: Column, names: dict[str, str]) -> Column:
    """Known labels by a table, others in snake case."""
    chain = F.regexp_replace(F.lower(F.trim(label)), r"\s+", "_")
    for known, column in names.items():
        chain = F.when(F.trim(label) == known, column).otherwise(chain)
    return chain


def parameter(params: Column, name: str) -> Column:
    """Value of the first ``{id, value}`` of a list with this id."""
    return F.get(F.filter(params, lambda p: p["id"] == name), F.lit(0))["value"]


def address_parts(location: Column) -> dict[str, Column]:
    """Province, district, ward and street texts, counted from the end of a comma-separated location."""
    parts = F.split(location, ",")
    at = lambda n: F.trim(F.try_element_at(parts, F.lit(-n)))
    ward = at(3)
    inside = F.regexp_extract(ward, r"\((.*?)\)", 1)
    former = F.lower(inside).rlike("quận|huyện|thị xã|thành phố")
    return {
        "province": F.coalesce(at(1), F.lit(UNKNOWN)),
        "district": F.when(former, F.trim(F.regexp_replace(inside, r"(?i)\s*cũ\s*", ""))).otherwise(F.coalesce(at(2), F.lit(UNKNOWN))),
        "ward": F.coalesce(F.trim(F.regexp_replace(ward, r"\s*\(.*?\)\s*", "")), F.lit(UNKNOWN)),
        "street": F.coalesce(at(4), F.when(F.size(parts) == 1, at(1)), F.lit(UNKNOWN)),
    }


def address_key(text: Column, level: str) -> Column:
    """Lower case without the administrative prefix; for streets also without lane numbers."""
    low = F.lower(F.trim(text))
    if level == "street":
        return F.regexp_replace(low, r"^(.*\s)?((hẻm|ngõ)\s+([0-9][0-9/]*\s+)?|(đường|phố)\s+)+", "")
    return F.regexp_replace(low, "^(" + "|".join(p + (r"\s*" if p.endswith(".") else r"\s+") for p in PREFIXES[level]) + ")+", "")


def loose_number(text: Column) -> Column:
    """Scientific notation as it is, other text by its digits; null where there are none."""
    t = F.trim(text)
    plain = t.rlike(r"^[-+]?[0-9]*\.?[0-9]+([eE][-+]?[0-9]+)?$")
    return F.when(plain, t.try_cast("double")).otherwise(F.nullif(F.regexp_replace(t, r"[^0-9.]", ""), F.lit("")).try_cast("double"))


def place_key(name: Column) -> Column:
    """One key for the spellings of a place: upper case, no city prefix, no spaces or hyphens."""
    bare = F.regexp_replace(F.upper(F.trim(name)), r"^(TP\.?|THÀNH PHỐ|TỈNH)\s*", "")
    return F.translate(bare, " -", "")


# The fields of an advertisement document that a listing takes.
AD_SCHEMA = "ad struct<list_id:long, subject:string, price:double, size:double, rooms:int, area_name:string, region_name:string, list_time:long>, parameters array<struct<id:string, value:string>>"


def advertisement(document: Column) -> Column:
    """A listing struct from an advertisement document; unreadable documents give null fields."""
    j = F.from_json(document, AD_SCHEMA)
    ad = j["ad"]
    return F.struct(
        ad["list_id"].alias("listing"), ad["subject"].alias("title"), ad["price"].alias("price"), ad["size"].alias("area"), ad["rooms"].alias("bedroom"),
        joined(ad["area_name"], ad["region_name"]).alias("location"), F.timestamp_millis(ad["list_time"]).alias("posted_date"),
        parameter(j["parameters"], "direction").try_cast("int").alias("house_direction_code"),
    )
