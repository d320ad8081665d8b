"""Parsing, standardisation, address and projection queries and their SQL twins.

The driver tables hold no messy text, so both sides build the same texts from table columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions import parse
from hearth.sources.adapters import listings, table, with_listings

TEXTS = {
    0: "5,2 tỷ", 1: "850 triệu", 2: "1.250 triệu", 3: "Thỏa thuận", 4: "35 triệu/m²", 5: "1500000000", 6: "900 nghìn", 7: "500k", 8: "", 9: "2,75 tỷ",
}
PPM2 = {4: "2,1 tỷ"}
AREAS = {0: "60 m²", 1: "1.200,5 m²", 2: "80", 3: "", 4: "60 m2"}
DIRECTION = {0: "Đông", 1: "Đông - Nam", 2: "tây bắc", 3: "Nam", 4: "", 5: "abc", 6: "Bắc", 7: "Tây - Nam"}
LEGAL = {0: "Sổ đỏ/ Sổ hồng", 1: "SHR", 2: "Đang chờ sổ", 3: "Không pháp lý", 4: "Hợp đồng mua bán", 5: "", 6: "abc"}
INTERIOR = {0: "Nội thất cao cấp", 1: "Không nội thất", 2: "Cơ bản", 3: "Full nội thất", 4: "abc", 5: "k", 6: ""}
TYPES = {0: "Villa", 1: "Căn hộ", 2: "đất nền", 3: "Shophouse", 4: "xyz"}
PLACES = {
    0: "Đường Lê Lợi, Phường Bến Thành, Quận 1, Hồ Chí Minh", 1: "Phường 1 (Quận 2 cũ), Thủ Đức, TP. Hồ Chí Minh",
    2: "Hẻm 136/10 Đường X, Xã Y, Huyện Z, Tỉnh Bình Dương", 3: "Hà Nội", 4: "Phố Huế, Phường Bạch Mai, Quận Hai Bà Trưng, Thành phố Hà Nội",
}


def _pick(index, texts):
    chain = F.lit(None).cast("string")
    for i, t in texts.items():
        chain = F.when(index == i, t).otherwise(chain)
    return chain


def _sql_pick(index: str, texts) -> str:
    return "CASE " + index + " " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in texts.items()) + " END"


def price_parse(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", _pick(F.col("p_partkey") % 10, TEXTS).alias("t"), _pick(F.col("p_partkey") % 10, PPM2).alias("m"), _pick(F.col("p_partkey") % 5, AREAS).alias("a"))
    price, per = parse.unswapped(F.col("t"), F.col("m"))
    rows = rows.where(~parse.invalid_unit(F.col("t"))).select("p_partkey", parse.unit_price(price).alias("price"), per.alias("per"), parse.local_number(F.col("a")).alias("area"))
    return rows.select("p_partkey", "price", "area", F.round(parse.per_m2_or_derived(F.col("per"), F.col("price"), F.col("area")), 2).alias("ppm2"))


_NUM = "try_cast(regexp_replace(replace(replace(regexp_replace(lower({0}), 'm2$', ''), '.', ''), ',', '.'), '[^0-9.]', '', 'g') AS DOUBLE)"


def _price_sql(x: str) -> str:
    n = _NUM.format(x)
    return f"CASE WHEN contains(lower({x}), 'thỏa thuận') THEN NULL WHEN contains(lower({x}), 'tỷ') THEN {n} * 1e9 WHEN contains(lower({x}), 'triệu') THEN {n} * 1e6 ELSE {n} END"


PRICE_SQL = f"""
WITH t AS (SELECT p_partkey, {_sql_pick("p_partkey % 10", TEXTS)} AS t0, {_sql_pick("p_partkey % 10", PPM2)} AS m0, {_sql_pick("p_partkey % 5", AREAS)} AS a FROM part),
s AS (SELECT p_partkey, a, CASE WHEN contains(t0, '/m²') AND m0 IS NOT NULL THEN m0 ELSE t0 END AS t, CASE WHEN contains(t0, '/m²') AND m0 IS NOT NULL THEN t0 ELSE m0 END AS m
  FROM t WHERE NOT (contains(t0, 'nghìn') OR regexp_matches(t0, '[0-9]+k$'))),
n AS (SELECT p_partkey, {_price_sql("t")} AS price, m, {_NUM.format("replace(a, ' m2', ' m2')")} AS area FROM s)
SELECT p_partkey, price, area, round(coalesce({_price_sql("replace(m, '/m²', '')")}, round(price / nullif(area, 0), 2)), 2) AS ppm2 FROM n
"""


def classified(spark, sf, texts, function, names):
    rows = table(spark, sf, "customer").select("c_custkey", _pick(F.col("c_custkey") % (len(texts) + 1), texts).alias("t"))
    name, code = function(F.col("t"))
    return rows.select("c_custkey", name.alias("name"), code.alias("code"))


def _class_sql(texts, answers: dict[int, tuple[str, int]]) -> str:
    index = f"c_custkey % {len(texts) + 1}"
    return (
        "SELECT c_custkey, CASE " + index + " " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, _) in answers.items()) + " ELSE 'unknown' END AS name, CASE "
        + index + " " + " ".join(f"WHEN {i} THEN {c}" for i, (_, c) in answers.items()) + " ELSE -1 END AS code FROM customer"
    )


def code_decode(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", (F.col("c_custkey") % 10).cast("string").alias("code"))
    out = {}
    for kind, names in (("direction", parse.DIRECTIONS), ("legal", parse.LEGAL), ("interior", parse.INTERIOR), ("house_type", parse.HOUSE_TYPES)):
        out[f"{kind}_text"], out[f"{kind}_code"] = parse.decode(F.col("code"), names)
    return rows.select("c_custkey", *[c.alias(n) for n, c in out.items()])


def _decode_sql() -> str:
    parts = []
    for kind, names in (("direction", parse.DIRECTIONS), ("legal", parse.LEGAL), ("interior", parse.INTERIOR), ("house_type", parse.HOUSE_TYPES)):
        cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in names.items())
        codes = ", ".join(map(str, names))
        parts.append(f"CASE c_custkey % 10 {cases} ELSE 'unknown' END AS {kind}_text, CASE WHEN c_custkey % 10 IN ({codes}) THEN c_custkey % 10 ELSE -1 END AS {kind}_code")
    return "SELECT c_custkey, " + ", ".join(parts) + " FROM customer"


def classify_type(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", _pick(F.col("c_custkey") % 7, TYPES).alias("t"), F.when(F.col("c_custkey") % 7 == 6, "Cho thuê văn phòng").otherwise("abc").alias("title"))
    return rows.select("c_custkey", parse.property_type(F.col("t"), F.col("title")).alias("kind"))


def address_split(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", _pick(F.col("c_custkey") % 6, PLACES).alias("location"))
    parts = parse.address_parts(F.col("location"))
    return rows.select("c_custkey", *[parse.address_key(c, level).alias(level) for level, c in parts.items()])


_ADDRESS = {
    0: ("hồ chí minh", "1", "bến thành", "lê lợi"), 1: ("hồ chí minh", "2", "1", "unknown"), 2: ("bình dương", "z", "y", "x"),
    3: ("hà nội", "unknown", "unknown", "hà nội"), 4: ("hà nội", "hai bà trưng", "bạch mai", "huế"),
}
ADDRESS_SQL = "SELECT c_custkey, " + ", ".join(
    "CASE c_custkey % 6 " + " ".join(f"WHEN {i} THEN '{v[k]}'" for i, v in _ADDRESS.items()) + f" ELSE 'unknown' END AS {level}" for k, level in enumerate(("province", "district", "ward", "street"))
) + " FROM customer"


def address_lookup(spark, sf):
    """Two levels of the hierarchy, nested then exploded, joined on composite keys; unresolved ids are -1."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    nested = nation.join(region, nation.n_regionkey == region.r_regionkey).groupBy("r_regionkey", "r_name").agg(F.collect_list(F.struct("n_nationkey", "n_name")).alias("districts"))
    flat = nested.select("r_regionkey", "r_name", F.explode("districts").alias("d")).select(
        F.col("r_regionkey").alias("province_id"), F.lower("r_name").alias("pk"), F.col("d.n_nationkey").alias("district_id"), F.lower("d.n_name").alias("dk")
    )
    provinces = flat.select("province_id", "pk").distinct()
    rows = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    raw = rows.select(
        "c_custkey", F.when(F.col("c_custkey") % 11 == 0, "Atlantis").otherwise(F.concat(F.lit("Tỉnh "), F.col("r_name"))).alias("province"),
        F.when(F.col("c_custkey") % 13 == 0, "Nowhere").otherwise(F.concat(F.lit("Quận "), F.col("n_name"))).alias("district"),
    )
    keyed = raw.select("c_custkey", parse.address_key(F.col("province"), "province").alias("pk"), parse.address_key(F.col("district"), "district").alias("dk"))
    one = keyed.join(provinces, "pk", "left")
    two = one.join(flat.select(F.col("province_id").alias("pid"), F.col("dk").alias("k"), "district_id"), (F.col("province_id") == F.col("pid")) & (F.col("dk") == F.col("k")), "left")
    return two.select("c_custkey", F.coalesce("province_id", F.lit(-1)).alias("province_id"), F.coalesce("district_id", F.lit(-1)).alias("district_id"))


PLANS = {
    "price_parse": (price_parse, PRICE_SQL),
    "direction_map": (
        lambda s, d: classified(s, d, DIRECTION, parse.direction, parse.DIRECTIONS),
        _class_sql(DIRECTION, {0: ("Đông", 1), 1: ("Đông Nam", 6), 2: ("Tây Bắc", 7), 3: ("Nam", 3), 6: ("Bắc", 4), 7: ("Tây Nam", 8)}),
    ),
    "legal_map": (
        lambda s, d: classified(s, d, LEGAL, parse.legal_status, parse.LEGAL),
        _class_sql(LEGAL, {0: ("Đã có sổ", 1), 1: ("Đã có sổ", 1), 2: ("Đang chờ sổ", 2), 3: ("Không có sổ", 4), 4: ("Sổ chung / Vi bằng", 5)}),
    ),
    "interior_map": (
        lambda s, d: classified(s, d, INTERIOR, parse.interior, parse.INTERIOR),
        _class_sql(INTERIOR, {0: ("Cao cấp", 1), 1: ("Bàn giao thô", 4), 2: ("Cơ bản", 3), 3: ("Đầy đủ", 2), 4: ("Đầy đủ", 2)}),
    ),
    "code_decode": (code_decode, _decode_sql()),
    "classify_type": (
        classify_type,
        "SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN 'house' WHEN 1 THEN 'apartment' WHEN 2 THEN 'land' WHEN 3 THEN 'commercial' WHEN 4 THEN 'other' WHEN 6 THEN 'commercial' ELSE 'house' END AS kind FROM customer",
    ),
    "address_split": (address_split, ADDRESS_SQL),
    "address_lookup": (
        address_lookup,
        "SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN -1 ELSE r_regionkey END AS province_id, CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN -1 ELSE n_nationkey END AS district_id FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    ),
    "url_id": (
        lambda s, d: table(s, d, "pages").select("page_id", parse.url_id(F.concat(F.lit("https://a.example/x/"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".htm").otherwise(""))).alias("listing"), parse.url_id(F.concat("url", F.lit("?"))).alias("none")),
        "SELECT page_id, page_id::VARCHAR AS listing, NULL::VARCHAR AS none FROM pages",
    ),
    "html_clean": (
        lambda s, d: table(s, d, "pages").select("page_id", parse.html_text(F.col("html")).alias("body")),
        r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gis'), '<!--.*?-->|<[^>]*>', ' ', 'gs'),
        '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n\f]+', ' ', 'g')) AS body FROM pages""",
    ),
    "html_links": (
        lambda s, d: table(s, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link")).groupBy("page_id").agg(F.count("*").alias("links"), F.min("link").alias("first_link")),
        """SELECT page_id, len(l) AS links, list_min(l) AS first_link FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages) WHERE len(l) > 0""",
    ),
    "map_coordinates": (
        lambda s, d: table(s, d, "supplier").select("s_suppkey", *[c.alias(n) for c, n in zip(parse.map_coordinates(F.concat(F.lit("https://maps.example/?q=10."), F.col("s_suppkey").cast("string"), F.lit(",106.5&z=3"))), ("lat", "lon"), strict=True)]),
        "SELECT s_suppkey, ('10.' || s_suppkey)::DOUBLE AS lat, 106.5::DOUBLE AS lon FROM supplier",
    ),
    "json_listing": (
        lambda s, d: table(s, d, "events").select("event_id", F.from_json("props", "k int").alias("j")).select("event_id", F.col("j.k").alias("k")),
        "SELECT event_id, (props::JSON->>'k')::INT AS k FROM events",
    ),
    "date_parse": (
        lambda s, d: table(s, d, "orders").select("o_orderkey", parse.day_month_year(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("posted"), F.unix_timestamp(parse.timestamp(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string"))).alias("crawled"), F.date_format("o_orderdate", "yyyy/MM/dd").alias("folder")),
        "SELECT o_orderkey, epoch(date_trunc('day', o_orderdate))::BIGINT AS posted, epoch(o_orderdate)::BIGINT AS crawled, strftime(o_orderdate, '%Y/%m/%d') AS folder FROM orders",
    ),
    "coordinate_bounds": (
        lambda s, d: listings(s, d).select("listing_key", parse.latitude(F.col("latitude") + 5).alias("lat"), parse.longitude(F.col("longitude") + 2).alias("lon")).agg(F.count("*").alias("n"), F.count("lat").alias("lat"), F.count("lon").alias("lon")),
        with_listings("SELECT count(*) AS n, count(*) FILTER (latitude + 5 BETWEEN 8 AND 23.5) AS lat, count(*) FILTER (longitude + 2 BETWEEN 102 AND 110) AS lon FROM listings"),
    ),
    "text_normalise": (
        lambda s, d: table(s, d, "customer").select("c_custkey", parse.key_text(F.concat(F.lit(" Ấp - "), F.col("c_name"), F.lit("_B "))).alias("k"), parse.snake_label(F.concat(F.lit("Mức giá "), F.col("c_mktsegment")), {}).alias("label")),
        "SELECT c_custkey, translate(lower(trim(' Ấp - ' || c_name || '_B ')), ' -_', '') AS k, regexp_replace(lower(trim('Mức giá ' || c_mktsegment)), '\\s+', '_', 'g') AS label FROM customer",
    ),
    "property_type": (
        lambda s, d: listings(s, d).select("listing_key", parse.derived_type(F.when(F.col("district_id") % 3 == 0, F.col("source")), F.col("bedroom"), F.col("area")).alias("kind")),
        with_listings("SELECT listing_key, CASE WHEN district_id % 3 = 0 THEN upper(source) WHEN bedroom > 0 THEN 'HOUSE' WHEN area > 0 THEN 'LAND' ELSE 'UNKNOWN' END AS kind FROM listings"),
    ),
}

