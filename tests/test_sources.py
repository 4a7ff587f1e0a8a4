import json

import pytest

from gridloom.sources import segments as S
from gridloom.sources import trials as T


@pytest.fixture
def tree(tmp_path):
    def put(path, data):
        p = tmp_path / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(data if isinstance(data, str) else json.dumps(data))

    put("jobs/a__1/config.json", {"agent": {"name": "ag", "model_name": "m1"}, "task": {"path": "/x/tasks/0450-L12-recon-full/"}})
    put("jobs/a__1/result.json", {"task_name": "reg/0450", "agent_execution": {"started_at": "2026-01-01T00:00:00Z", "finished_at": "2026-01-01T00:01:30.250Z"}})
    put("jobs/a__1/agent/trajectory.json", {"steps": [{"tool_calls": [{"id": 1}, {"id": 2}]}, {}, {"tool_calls": None}], "final_metrics": {"total_prompt_tokens": 10, "total_cost_usd": 0.5}})
    put("jobs/a__1/artifacts/app/answers.json", {"S!A1": 1.0, "S!A2": 7, "S!B1": "2.5"})
    put("jobs/a__1/verifier/answers.json", {"S!A1": 99})
    put("jobs/b__2/result.json", {"exception_info": {"exception_type": "Timeout"}})
    put("jobs/b__2/config.json", "{broken")
    put("jobs/0450-L12-recon-full__3/result.json", {})
    put("jobs/0450-L12-recon-full__3/verifier/answers.json", {"S!A1": 1.0, "S!A2": 2.0})
    put("jobs/notes/other.json", {})
    put("tasks/0450-L12-recon-full/tests/answer_key.json", {"kind": "cell_value", "targets": {"S!A1": 1.0, "S!A2": 2.0, "S!B1": 2.5}, "groups": {"S!A1": "g", "S!A2": "g", "S!B1": "h"}})
    put("workbooks.json", {"0450.xlsx": {"primary": "debt"}, "9.xlsx": {}})
    return f"file://{tmp_path}"


def test_trials_and_their_scores(spark, tree):
    found = T.trials(spark, f"{tree}/jobs", T.taxonomy(spark, f"{tree}/workbooks.json")).cache()
    rows = {r.trial: r for r in found.collect()}
    assert set(rows) == {"a__1", "b__2", "0450-L12-recon-full__3"}
    a, b, c = rows["a__1"], rows["b__2"], rows["0450-L12-recon-full__3"]
    assert (a.task, a.agent, a.model, a.elapsed_sec, a.n_steps, a.n_tool_calls, a.prompt_tokens, a.cost_usd, a.cutoff, a.template, a.workbook, a.family, a.answers_source) == ("0450-L12-recon-full", "ag", "m1", 90.3, 3, 2, 10, 0.5, 12, "recon-full", "0450", "debt", "artifacts/app/answers.json")
    assert (b.task, b.exception, b.faults, b.answers_source, b.cutoff, b.workbook, b.template, b.family) == ("b", "Timeout", ["config.json"], "", None, "b", "", "")
    assert c.task == "0450-L12-recon-full" and c.answers == {"S!A1": "1.0", "S!A2": "2.0"} and a.faults == []
    scores = {r.trial: r for r in T.trial_scores(found, T.keys(spark, f"{tree}/tasks")).collect()}
    assert scores["b__2"].error == "no answer key" and scores["b__2"].score is None
    assert scores["a__1"].targets == 3 and scores["a__1"].exact == 2 and 0.75 <= scores["a__1"].score < 1
    assert scores["0450-L12-recon-full__3"].exact == 2 and scores["0450-L12-recon-full__3"].score == pytest.approx(0.5)


def test_csv_keeps_books_and_odd_texts(spark, tmp_path):
    rows = [("0450", "S!A1", "a \"q\", b\nc", 3, None), ("0450", "S!B1", "", 1, 0.5), ("x y", "S!A1", "é", 2, -1.0)]
    S.write_csv(spark.createDataFrame(rows, "wb string, band string, label string, row int, depth double"), f"file://{tmp_path}/bands", S.BAND_FIELDS)
    back = S.read_csv(spark, f"file://{tmp_path}/bands", S.BAND_FIELDS, {"row": "int", "depth": "double"})
    assert back.columns == [*S.BAND_FIELDS, "wb"]
    assert sorted((r.wb, r.band, r.label or "", r.row, r.depth) for r in back.collect()) == sorted(rows, key=lambda r: r[:2])
    assert all(r.bucket is None for r in back.collect())


def test_curation(spark, tmp_path):
    rows = [("0450", 1, "S!A1", "S", 'Total "net"\t\\n', 9.5), ("0450", 2, "S!B1", "S", None, 2.0), ("0450", 3, "S!C1", "S", "c # d", 1.0), ("b", 1, "S!A1", "T", "x = y", 7.0)]
    df = spark.createDataFrame(rows, "wb string, rank int, band string, sheet string, label string, score double")
    S.write_curation(df, f"file://{tmp_path}/c", 6.0, top=2, fallback=spark.createDataFrame([("0450", "S!B1")], "wb string, band string"))
    got = {(r.wb, r.nth): r for r in S.read_curation(spark, f"file://{tmp_path}/c").collect()}
    assert got.keys() == {("0450", 1), ("0450", 2), ("b", 1)}
    assert got["0450", 1].label == 'Total "net"\t\\n' and got["0450", 1].include and got["0450", 1].score == 9.5
    assert got["0450", 2].include and got["0450", 2].name == "S!B1" and got["b", 1].label == "x = y"
    text = "# hand\n[[output]]\nband = \"B\"\ninclude = false  # heuristic: true\nname = \"a # b\"\n\n [[output]]\nband = \"C\"\n"
    (tmp_path / "h" / "wb=0007").mkdir(parents=True)
    (tmp_path / "h" / "wb=0007" / "curation.toml").write_text(text)
    hand = [tuple(r) for r in S.read_curation(spark, f"file://{tmp_path}/h").orderBy("nth").collect()]
    assert hand == [("0007", 1, "B", None, None, None, False, "a # b"), ("0007", 2, "C", None, None, None, None, None)]


def test_segments(spark, tmp_path):
    rows = [("w", "S!A1", "input", None, "S", "l", 1, "input", "numeric", 0, "S!A1", True, False), ("w", "S!B1", "output", None, "S", "o", 1, "formula", "numeric", 1, "S!B1", True, False), ("w", "S!C1", "scaffolding", "dead", "S", "", 1, "formula", "text", 0, "S!C1", True, False), ("w", "V!A1", None, None, "V", "", 2, "formula", "numeric", None, None, False, True)]
    df = spark.createDataFrame(rows, "wb string, band string, bucket string, subclass string, sheet string, label string, width int, kind string, vtype string, depth int, comp string, primary boolean, is_mirror boolean")
    S.write_segments(df, f"file://{tmp_path}/s", spark.createDataFrame([("w", "match", 3)], "wb string, verdict string, n int"))
    (one,) = spark.read.text(f"file://{tmp_path}/s").collect()
    got = json.loads(one.value)
    assert got["workbook"] == "w" and got["counts"] == {"bands": 4, "mirror_bands": 1, "components": 3, "input": 1, "middle": 0, "output": 1} and got["verification"] == {"match": 3}
    assert [x["band"] for x in got["outputs"]] == ["S!B1"] and got["scaffolding"]["dead"] == ["S!C1"] and got["presentation_bands"] == ["V!A1"]


def test_a_task_that_fails_leaves_nothing(spark, tmp_path):
    df = spark.range(100).selectExpr("cast(id % 3 as string) as wb", "cast(id as string) as band", "case when id = 77 then raise_error('lost') else 'x' end as label")
    with pytest.raises(Exception, match="lost"):
        S.write_csv(df, f"file://{tmp_path}/f", ["band", "label"])
    left = [p for p in (tmp_path / "f").rglob("*.csv")] if (tmp_path / "f").exists() else []
    assert not left and not (tmp_path / "f" / "_SUCCESS").exists()
