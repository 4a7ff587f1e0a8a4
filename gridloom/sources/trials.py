"""Trials of tasks as folders of JSON: read through Spark's file source, joined to their keys and families, scored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grading import grade

#: The files of a trial, where answers may lie (the first counts), the cutoff in a task's name.
CONFIG, RESULT, TRAJECTORY = "config.json", "result.json", "agent/trajectory.json"
ANSWERS = ("artifacts/app/answers.json", "verifier/answers.json")
KEY = "tests/answer_key.json"
CUTOFF = r"-L([0-9]+)-"


def json_files(spark: SparkSession, root: str, names: tuple[str, ...]) -> DataFrame:
    """(folder, name, text) of the files below root whose path ends with one of the names, whichever store root is in."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root).select("path", "content")
    end = "/(" + "|".join(n.replace(".", r"\.") for n in names) + ")$"
    path = F.col("path")
    return found.where(path.rlike(end)).select(F.regexp_replace(path, end, "").alias("folder"), F.regexp_extract(path, end, 1).alias("name"), F.decode("content", "UTF-8").alias("text"))


def _last(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def trials(spark: SparkSession, root: str, families: DataFrame | None = None) -> DataFrame:
    """A row for each trial's folder: what ran, how long, with how many steps, tokens and costs, its answers and faults.

    A folder is a trial if it holds a config or a result. The task is the one that the config names, else what stands
    before __ in the folder's name. faults: the files that are no JSON; what they would say is null. families: (workbook,
    family).
    """
    names = (CONFIG, RESULT, TRAJECTORY, *ANSWERS)
    files = json_files(spark, root, names)
    text = {n: F.max(F.when(F.col("name") == n, F.col("text"))).alias(f"_{i}") for i, n in enumerate(names)}
    rows = files.groupBy("folder").agg(*text.values()).where("_0 is not null or _1 is not null")
    rows = rows.withColumns({f"_v{i}": F.try_parse_json(f"_{i}") for i in range(len(names))})
    get = lambda i, path, kind="string": F.try_variant_get(f"_v{i}", path, kind)
    broken = F.array_compact(F.array(*(F.when(F.col(f"_{i}").isNotNull() & F.col(f"_v{i}").isNull(), n) for i, n in enumerate(names))))
    steps = F.from_json("_2", "steps array<struct<tool_calls: array<string>>>")["steps"]
    when = lambda path: F.try_to_timestamp(F.replace(get(1, path), F.lit("Z"), F.lit("+00:00")))
    took = F.unix_micros(when("$.agent_execution.finished_at")) - F.unix_micros(when("$.agent_execution.started_at"))
    named = _last(F.rtrim(get(0, "$.task.path"), F.lit("/")))
    task = F.coalesce(F.when(named != "", named), F.split_part(_last(F.col("folder")), F.lit("__"), F.lit(1)))
    source = F.when(F.col("_v3").isNotNull(), ANSWERS[0]).when(F.col("_v4").isNotNull(), ANSWERS[1]).otherwise("")
    cutoff = F.regexp_extract(task, CUTOFF, 1)
    dashed = F.contains(task, F.lit("-"))
    parts = F.split(task, "-", 3)
    out = rows.select(
        _last(F.col("folder")).alias("trial"), task.alias("task"), get(1, "$.task_name").alias("registry_name"), get(0, "$.agent.name").alias("agent"), get(0, "$.agent.model_name").alias("model"), F.round(took / 1e6, 1).alias("elapsed_sec"), get(1, "$.exception_info.exception_type").alias("exception"),
        F.greatest(F.size(F.coalesce(steps, F.array())), F.lit(0)).alias("n_steps"), F.coalesce(F.aggregate(F.coalesce(steps, F.array()), F.lit(0), lambda n, s: n + F.coalesce(F.size(F.coalesce(s["tool_calls"], F.array())), F.lit(0))), F.lit(0)).alias("n_tool_calls"),
        get(2, "$.final_metrics.total_prompt_tokens", "long").alias("prompt_tokens"), get(2, "$.final_metrics.total_completion_tokens", "long").alias("completion_tokens"), get(2, "$.final_metrics.total_cached_tokens", "long").alias("cached_tokens"), get(2, "$.final_metrics.total_cost_usd", "double").alias("cost_usd"),
        F.when(cutoff != "", cutoff.cast("int")).alias("cutoff"), F.when(dashed, F.element_at(parts, -1)).otherwise("").alias("template"), F.when(dashed, parts[0]).otherwise(task).alias("workbook"), source.alias("answers_source"),
        F.from_json(F.when(source == ANSWERS[0], F.col("_3")).when(source == ANSWERS[1], F.col("_4")), "map<string,string>").alias("answers"), broken.alias("faults"),
    )
    if families is None:
        return out.withColumn("family", F.lit(""))
    return out.join(families.select("workbook", "family").dropDuplicates(["workbook"]), "workbook", "left").withColumn("family", F.coalesce("family", F.lit(""))).select(*out.columns, "family")


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(workbook, family) of a JSON file of {file name: {"primary": family}}."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string, struct<primary: string>>").alias("m"))
    return text.select(F.explode("m").alias("name", "entry")).select(F.regexp_replace("name", r"\.[^.]*$", "").alias("workbook"), F.coalesce("entry.primary", F.lit("")).alias("family"))


def keys(spark: SparkSession, root: str) -> DataFrame:
    """(task, kind, targets, groups) of the answer keys of tasks below root."""
    text = json_files(spark, root, (KEY,)).select(_last(F.col("folder")).alias("task"), F.from_json("text", "kind string, targets map<string,string>, groups map<string,string>").alias("k"))
    return text.select("task", "k.kind", "k.targets", "k.groups")


def trial_scores(found: DataFrame, key: DataFrame, absolute: float = 1e-9, relative: float = 1e-6) -> DataFrame:
    """(trial, task, error, targets, exact, score): each trial with its key; without one, or without answers, an error.

    A target counts by its group's weight; an answer that isn't a number scores 0.
    """
    rows = found.select("trial", "task", "answers", "answers_source").join(key, "task", "left")
    error = F.when(F.col("targets").isNull(), "no answer key").when(F.col("answers_source") == "", "no answers")
    rows = rows.withColumn("error", error)
    able = rows.where("error is null")
    want = able.select(F.struct("trial", "task").alias("task"), "groups", F.explode("targets").alias("ref", "_want")).select("task", "ref", F.try_element_at("groups", F.col("ref")).alias("grp"), F.col("_want").try_cast("double").alias("expected"))
    gave = able.select(F.struct("trial", "task").alias("task"), F.explode("answers").alias("ref", "_gave")).select("task", "ref", F.col("_gave").try_cast("double").alias("given"))
    graded = grade(want, gave, absolute, relative).groupBy("task.trial", "task.task").agg(F.count(F.lit(1)).alias("targets"), F.count_if("exact").alias("exact"), F.sum(F.col("score") * F.col("weight")).alias("score"))
    return rows.select("trial", "task", "error").join(graded, ["trial", "task"], "left")
