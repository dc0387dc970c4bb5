"""Children of the root of XML documents read by ranges, against Python's own parser."""

import os
import xml.etree.ElementTree as ET

import pytest

from sluice.sources import read_root_records
from sluice.sources.xml_records import xml_record_texts

DOCUMENT = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE nutrition [ <!ELEMENT food ANY> <!ELEMENT x (y)> ]>
<!-- <food>in a comment</food> > - > -->
<nutrition note="a > b" other='"&gt;> &lt;food>'>
%s
  <group><food>nested</food><food/></group>
  <![CDATA[ <food>text</food> ]] > ]]>
  <foods>other</foods>
  <food   a="1>2" b='/>'/>
  <food
     a="three >"
  >long &gt; <food>inner</food> <![CDATA[</food>]]> <!-- </food> --> > tail</food >
  <?go <food>?>
  <food/>
</nutrition>
<!-- > end -->
"""


def plain(text):
    return sorted(ET.canonicalize(ET.tostring(e, "unicode").strip()) for e in cut(ET.fromstring(text).findall("food")))


def cut(elements):
    for e in elements:
        e.tail = None
    return elements


def set_range(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)


@pytest.fixture(autouse=True)
def ranges_back(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [23, 31, 64, 200, 10**6])
def test_children_of_the_root(spark, tmp_dir, size):
    wanted = []
    for k in range(3):
        text = DOCUMENT % "".join(f"<food id='{i}'><name>n{i}&lt;</name>{'<x/>' * (i % 3)}</food>" for i in range(5 * k))
        with open(os.path.join(tmp_dir, f"{k}.xml"), "w") as f:
            f.write(text)
        wanted += plain(text)
    set_range(spark, size)
    got = [ET.canonicalize(r.text.strip()) for r in xml_record_texts(spark, tmp_dir, "food").collect()]
    assert sorted(got) == sorted(wanted)


def test_typed_rows_and_files_without_records(spark, tmp_dir):
    texts = {"a": '<r><food><name>x</name><v u="g">1</v></food></r>', "b": "<r/>", "c": "", "d": "<food><name>root</name></food>"}
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
    set_range(spark, 20)
    got = read_root_records(spark, tmp_dir, "food", spark.createDataFrame([], "name string, v struct<_VALUE:string,_u:string>").schema)
    assert [(r.name, r.v["_VALUE"], r.v["_u"]) for r in got.collect()] == [("x", "1", "g")]


@pytest.mark.parametrize("size", [40, 150, 10**6])
def test_outermost_records_as_sparks_reader(spark, tmp_dir, size):
    from sluice.sources import read_xml_records

    foods = "".join(f"<food id='{i}'><name>n{i} &lt;</name>\n<food><name>inner</name></food></food>" for i in range(20))
    with open(os.path.join(tmp_dir, "a.xml"), "w") as f:
        f.write(f"<?xml version='1.0'?>\n<r><!-- <food> --><deep>{foods}<more><food id='x'/></more></deep>\n<food id='y'><name>z</name></food></r>")
    with open(os.path.join(tmp_dir, "b.xml"), "w") as f:
        f.write("<food id='root'><name>alone</name></food>")
    schema = "_id string, name string"
    wanted = spark.read.format("xml").option("rowTag", "food").schema(schema).load(tmp_dir).collect()
    set_range(spark, size)
    got = read_xml_records(spark, tmp_dir, "food", schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted)) and len(wanted) == 23
    if size == 150:
        assert got.rdd.getNumPartitions() > 5


@pytest.mark.parametrize("size", [40, 10**6])
def test_a_record_that_breaks_off_is_an_error(spark, tmp_dir, size):
    from sluice.sources import read_xml_records

    with open(os.path.join(tmp_dir, "a.xml"), "w") as f:
        f.write("<r>" + "<food><name>n</name></food>" * 5 + "<food><name>broken off, far from the end of its")
    set_range(spark, size)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_xml_records(spark, tmp_dir, "food", "name string").collect()
