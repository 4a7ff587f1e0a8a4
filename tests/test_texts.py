from xml.etree import ElementTree as ET

from gridloom.sources import texts


def test_markdown(spark, tmp_path):
    (tmp_path / "a.md").write_text("# T\n| Name | Value |\n|---|---:|\n| Net debt | 1 |\n| Net debt | 2 |\n\ntext\n\n| X |\n|-|\n| é & y |\n")
    got = [(list(r.cells), r.draft_id) for r in texts.markdown_rows(spark, f"file://{tmp_path}/a.md").collect()]
    assert sorted(got) == sorted([(["Net debt", "1"], "net-debt"), (["Net debt", "2"], "net-debt-2"), (["é & y"], "y")])


def test_graphml_and_json(spark, tmp_path):
    nodes = spark.createDataFrame([("a<b", 1, None), ("c", 2, "x&y")], "id string, row int, label string")
    edges = spark.createDataFrame([("a<b", "c", True)], "src string, dst string, cross boolean")
    texts.graphml(nodes, edges, f"file://{tmp_path}/g")
    whole = "\n".join(p.read_text() for p in sorted((tmp_path / "g").glob("part-*")))
    tree = ET.fromstring(whole)
    assert [x.get("id") for x in tree.iter("{http://graphml.graphdrawing.org/xmlns}node")] == ["a<b", "c"] and "boolean" in whole
    assert texts.as_json(nodes.select("row", "id"), "row").orderBy("row").first().json == '[{"id":"a<b"}]'
