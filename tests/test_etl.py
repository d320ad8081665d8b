"""The daily pipeline from raw JSON lines to gold, and the load into the serving table."""

import json

import pytest
from pyspark.sql import functions as F

from hearth import session
from hearth.operators import etl
from hearth.sources import buckets

PLACES = [
    {"id": "1", "name": "Hồ Chí Minh", "districts": [{"id": "11", "name": "Quận 1", "wards": [{"id": "111", "name": "Phường Bến Thành", "prefix": "Phường"}], "streets": [{"id": "112", "name": "Đường Lê Lợi", "prefix": "Đường"}]}]},
]
HERE = "Đường Lê Lợi, Phường Bến Thành, Quận 1, Hồ Chí Minh"
A = [
    {"url": "u1", "source": "a", "title": "Nhà 1", "location": HERE, "price": "5,2 tỷ", "area": "100 m²", "bedroom": "3 phòng", "bathroom": "2", "latitude": "10.7", "longitude": "106.7", "house_direction": "Đông - Nam", "posted_date": "1747699200", "data_type": "house"},
    {"url": "u1", "source": "a", "title": "Nhà 1", "location": HERE, "price": "5,2 tỷ", "area": "100 m²", "bedroom": "3 phòng", "bathroom": "2", "data_type": "house"},
    {"url": "u2", "source": "a", "title": "Nhà 2", "location": HERE, "price": "900 nghìn", "area": "50 m²"},
    {"url": "u3", "source": "a", "title": "Nhà 3", "location": "Xã X, Huyện Y, Tỉnh Z", "price": "2 tỷ", "area": "50 m²"},
    {"url": "u4", "source": "a", "title": "Nhà 4", "location": HERE, "price": "Thỏa thuận", "area": "50 m²"},
]
B = [
    {"url": "v1", "source": "b", "title": "Nhà 5", "location": HERE, "price": "1500000000", "area": "60.5", "house_direction": "3", "legal_status": "1", "house_type": "2", "bedroom": "2"},
    {"url": "v2", "source": "b", "title": "Nhà 1", "location": HERE, "price": "5200000000", "area": "101", "bedroom": "3", "bathroom": "2"},
]


def lines(path, rows):
    path.mkdir()
    (path / "x.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    return str(path)


def test_daily_run(spark, tmp_path):
    (tmp_path / "h.json").write_text(json.dumps(PLACES, ensure_ascii=False))
    rows = session.run_daily(spark, lines(tmp_path / "a", A), lines(tmp_path / "b", B), str(tmp_path / "h.json"), str(tmp_path / "out"), "2025-05-20", "job")
    got = {r.url: r for r in rows.collect()}
    # u1 twice and v2 alike: one stays, by score; invalid units, negotiable prices and unknown provinces are gone.
    assert set(got) == {"u1", "v1"}
    u1, v1 = got["u1"], got["v1"]
    assert (u1.price, u1.area, u1.price_per_m2, u1.house_direction, u1.house_direction_code) == (5.2e9, 100.0, 5.2e7, "Đông Nam", 6)
    assert (u1.province_id, u1.district_id, u1.ward_id, u1.street_id, u1.data_quality_score) == (1, 11, 111, 112, 100.0)
    assert (v1.price, v1.area, v1.house_direction, v1.legal_status, v1.house_type, v1.property_type) == (1.5e9, 60.5, "Nam", "Đã có sổ", "Biệt thự", "HOUSE")
    again = session.run_daily(spark, None, str(tmp_path / "b"), str(tmp_path / "h.json"), str(tmp_path / "out"), "2025-05-21", "job")
    assert again.count() == 2 and spark.read.parquet(str(tmp_path / "out/gold")).count() == 4

    serving = rows.drop("dt")
    newer = again.drop("dt").select(*serving.columns).withColumn("price", F.col("price") + 1)
    after = {r.url: r.price for r in etl.load(serving, newer, F.lit("2025-05-22").cast("timestamp")).collect()}
    assert after["v1"] == 1.5e9 + 1 and after["u1"] == 5.2e9


def test_stages_are_chosen(spark, tmp_path):
    """A run that ends early, one that goes on from there, and two loads into the serving table."""
    (tmp_path / "h.json").write_text(json.dumps(PLACES, ensure_ascii=False))
    raw, h, out = lines(tmp_path / "b", B), str(tmp_path / "h.json"), str(tmp_path / "out")
    assert session.run_daily(spark, None, raw, h, out, "2025-05-20", "job", session.chosen(["bronze"])) is None
    assert spark.read.parquet(f"{out}/bronze/b").count() == 2
    gold = session.run_daily(spark, None, None, h, out, "2025-05-20", "job", session.chosen(skip=["bronze"]))
    assert gold.count() == 2 and buckets.read(spark, f"{out}/serving").count() == 2
    session.run_daily(spark, None, raw, h, out, "2025-05-21", "job", session.chosen())
    served = buckets.read(spark, f"{out}/serving").collect()
    assert len(served) == 2 and {str(r.processing_timestamp)[:10] for r in served} == {"2025-05-21"}
    with pytest.raises(ValueError, match="nothing is stored"):
        session.run_daily(spark, None, None, h, out, "2025-06-01", "job", ["gold"])
