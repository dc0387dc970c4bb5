import json
import os

import pytest
from pyspark.sql import functions as F

from sluice.plans.documents import nutrition_flat, order_headers, order_item_totals, order_items, order_status_steps, pets_flat
from sluice.schemas import DELIVERY_ORDER_DOC, FOOD_XML, PETS_DOCUMENT
from sluice.sources.files import read_json_documents, read_xml_records


def test_pets_json_documents(spark, tmp_dir):
    d = os.path.join(tmp_dir, "pets")
    os.makedirs(d)
    doc = {"pets": [
        {"name": "Rex", "species": "dog", "birthYear": 2015, "favFoods": ["beef", "rice"], "photo": "r.jpg"},
        {"name": "Tom", "species": "cat", "favFoods": [], "photo": "t.jpg"},
        {"name": "Bob", "species": "fish"},
    ]}
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump(doc, f, indent=2)  # one pretty-printed object per file
    with open(os.path.join(d, "b.json"), "w") as f:
        json.dump({"pets": []}, f)
    rows = {r["name"]: r for r in pets_flat(read_json_documents(spark, d, PETS_DOCUMENT)).collect()}
    assert set(rows) == {"Rex", "Tom", "Bob"}
    assert rows["Rex"]["fav_foods"] == "beef, rice" and rows["Rex"]["birth_year"] == 2015
    assert rows["Tom"]["fav_foods"] == "" and rows["Tom"]["birth_year"] is None
    assert rows["Bob"]["fav_foods"] is None and rows["Bob"]["photo"] is None


XML = """<?xml version="1.0"?>
<nutrition>
  <food>
    <name>Avocado Dip</name><mfr>Sunnydale</mfr>
    <serving units="g">29</serving><calories total="110" fat="100"/>
    <total-fat>11</total-fat><saturated-fat>3</saturated-fat><cholesterol>5</cholesterol>
    <sodium>210</sodium><carb>2</carb><fiber>0</fiber><protein>1</protein>
    <vitamins><a>0</a><c>0</c></vitamins><minerals><ca>0</ca><fe>0</fe></minerals>
  </food>
  <food>
    <name>Bagels &amp; Co</name>
    <serving units="g"/><calories total="300" fat=""/>
    <total-fat></total-fat><sodium>520</sodium>
    <minerals><ca>8</ca></minerals>
  </food>
</nutrition>
"""


def test_nutrition_xml(spark, tmp_dir):
    p = os.path.join(tmp_dir, "nutrition.xml")
    with open(p, "w") as f:
        f.write(XML)
    rows = {r["name"]: r for r in nutrition_flat(read_xml_records(spark, p, "food", FOOD_XML)).collect()}
    a, b = rows["Avocado Dip"], rows["Bagels & Co"]
    assert (a["serving"], a["serving_units"], a["calories_total"], a["calories_fat"]) == (29.0, "g", 110.0, 100.0)
    assert a["fiber"] == 0.0 and a["vit_c"] == 0.0 and a["total_fat"] == 11.0
    assert b["mfr"] is None and b["serving"] is None and b["serving_units"] == "g"
    assert b["calories_total"] == 300.0 and b["calories_fat"] is None and b["total_fat"] is None
    assert b["vit_a"] is None and b["min_ca"] == 8.0 and b["min_fe"] is None
    assert len(nutrition_flat(read_xml_records(spark, p, "food", FOOD_XML)).columns) == 17


def test_nutrition_junk_number_raises_unless_lenient(spark):
    df = spark.createDataFrame([("<food><name>x</name><sodium>abc</sodium></food>",)], "x string")
    parsed = df.select(F.from_xml("x", FOOD_XML).alias("f"))
    with pytest.raises(Exception):
        nutrition_flat(parsed, "f").collect()
    assert nutrition_flat(parsed, "f", lenient=True).first()["sodium"] is None


ORDER = {
    "status": "success",
    "data": {
        "order_id": "9001", "date": "2021-05-04",
        "customer": {"id": "17", "name": "A. Buyer", "phone": "+0", "address": {"street": "1 Road", "city": "Town", "state": "ST", "zip": "00001"}},
        "restaurant": {"id": "5", "name": "Noodle Bar", "address": {"street": "2 Road", "city": "Town", "state": "ST", "zip": "00002"}},
        "delivery": {"type": "courier", "courier_name": "C", "courier_phone": "+1", "eta": "2021-05-04T12:40:00Z", "fee": 3.5, "instructions": "none"},
        "payment": {"method": "card", "total": 40.0, "currency": "EUR"},
        "items": [
            {"dish_id": "1", "name": "Ramen", "quantity": "3x", "price": 10.0, "addons": [{"name": "Egg", "price": 1.0}, {"name": "Chili", "price": 0.5}]},
            {"dish_id": "2", "name": "Tea", "quantity": "1x", "price": 2.0, "addons": []},
        ],
        "status_history": [
            {"status": "created", "time": "2021-05-04T12:00:00Z"},
            {"status": "cooking", "time": "2021-05-04T12:05:30Z"},
            {"status": "delivered", "time": "2021-05-04T12:35:00Z"},
        ],
    },
}


def test_delivery_document(spark, tmp_dir):
    p = os.path.join(tmp_dir, "order.json")
    with open(p, "w") as f:
        json.dump(ORDER, f, indent=2)
    docs = read_json_documents(spark, p, DELIVERY_ORDER_DOC)
    h = order_headers(docs, None).first()
    assert (h["order_id"], h["customer_city"], h["delivery_fee"], h["currency"]) == ("9001", "Town", 3.5, "EUR")
    items = sorted((r["dish_name"], r["quantity"], r["addon_name"]) for r in order_items(docs, None).collect())
    assert items == [("Ramen", 3, "Chili"), ("Ramen", 3, "Egg"), ("Tea", 1, None)]
    tot = order_item_totals(docs, None).first()
    assert tot["n_items"] == 2 and tot["items_subtotal"] == pytest.approx(3 * (10.0 + 1.5) + 2.0)
    steps = sorted((r["step"], r["prev_status"], r["minutes_since_prev"]) for r in order_status_steps(docs, None).collect())
    assert steps == [(0, None, None), (1, "created", 5.5), (2, "cooking", 29.5)]


def test_single_step_history_and_empty_addons(spark, tmp_dir):
    doc = json.loads(json.dumps(ORDER))
    doc["data"]["status_history"] = [{"status": "created", "time": "2021-05-04T12:00:00Z"}]
    doc["data"]["items"] = [{"dish_id": "9", "name": "Soup", "quantity": "2x", "price": 4.0, "addons": []}]
    p = os.path.join(tmp_dir, "one.json")
    with open(p, "w") as f:
        json.dump(doc, f)
    docs = read_json_documents(spark, p, DELIVERY_ORDER_DOC)
    steps = [tuple(r)[1:] for r in order_status_steps(docs, None).select("order_id", "step", "prev_status", "minutes_since_prev").collect()]
    assert steps == [(0, None, None)]
    items = [(r["quantity"], r["addon_name"]) for r in order_items(docs, None).collect()]
    assert items == [(2, None)]
    assert order_item_totals(docs, None).first()["items_subtotal"] == 8.0
