"""Leaks and labels: values that repeat an answer, in numbers or in prose; families by keyword; fences and lists in answers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def leaks(cells: DataFrame, targets: DataFrame, value: str = "value", target: str = "target", by: list[str] | None = None, inside: str | None = None) -> DataFrame:
    """cells that equal a target (deny, within 1e-12 of its size) or agree with it in four digits (suspect).

    by: columns of both, a book's key: a cell is compared with its own book's targets only. inside: a column of cells, whether
    a cell lies inside the frontier, where an equal value is suspect too.

    Whole numbers under 10,000 are ignored. Instead of comparing all with all, both sides carry the four-digit form as a
    key, and a cell at an edge of rounding also the one beyond it, so equal values whose rounding differs still meet. Below 2e-8, where 1e-12
    may span many four-digit forms, both also carry a step of a fixed grid.
    """

    def form(x: Column) -> Column:  # the place of the number to four significant digits among all such, so 9999.6 and 10000.4 share one
        power = F.floor(F.log10(F.abs(x))) - 3
        return (power * 9000 + F.floor(F.abs(x) / F.pow(F.lit(10.0), power) + 0.5) - 1000).cast("long")

    def tiny(x: Column) -> Column:
        return F.abs(x) < 2e-8

    def keys(x: Column, around: bool) -> Column:  # sign 2: the grid
        reach = 2e-12 * F.greatest(F.lit(1.0), F.abs(x))  # next to an edge of rounding a number has two forms in reach
        forms = F.array_distinct(F.array(form(x - reach), form(x), form(x + reach))) if around else F.array(form(x))
        near = F.transform(forms, lambda n: F.struct(n.alias("n"), F.signum(x).cast("int").alias("s")))
        grid = F.array(*(F.struct((F.floor(x / 2e-12) + i).cast("long").alias("n"), F.lit(2).alias("s")) for i in ((-1, 0, 1) if around else (0,))))
        return F.explode(F.when(tiny(x), F.concat(near, grid)).otherwise(near))

    v, t = F.col(value), F.col(target)
    telling = cells.where((v != 0) & ~((v == F.floor(v)) & (F.abs(v) < 10000))).withColumn("_k", keys(v, True))
    met = telling.join(targets.where(t != 0).withColumn("_k", keys(t, False)), [*(by or []), "_k"])
    exact = F.abs(v - t) <= 1e-12 * F.greatest(F.lit(1.0), F.abs(t))
    apart = F.when(F.signum(v) == F.signum(t), F.abs(form(v) - form(t))).otherwise(2)
    # two tiny numbers of unlike forms meet on the grid alone, so no pair is found twice
    met = met.where(F.when(F.col("_k.s") == 2, exact & (apart > 0)).otherwise((apart == 0) | (exact & ~(tiny(v) & tiny(t)))))
    denied = exact if inside is None else exact & ~F.coalesce(F.col(inside), F.lit(False))
    return met.withColumn("kind", F.when(denied, "deny").otherwise("suspect")).drop("_k")


def numbers_in(text: str | Column) -> Column:
    """All numbers of a text, thousands' commas taken out; those before % also as hundredths."""
    text = F.col(text) if isinstance(text, str) else text
    found = F.regexp_extract_all(text, F.lit(r"[0-9][0-9,]*(?:\.[0-9]+)?%?"), F.lit(0))
    plain = F.transform(found, lambda x: F.regexp_replace(x, "[,%]", "").try_cast("double"))
    shares = F.transform(F.filter(found, lambda x: x.endswith("%")), lambda x: F.regexp_replace(x, "[,%]", "").try_cast("double") / 100)
    return F.filter(F.concat(plain, shares), lambda x: x.isNotNull())


#: Characters of the phrases that one pass looks for: what is broadcast at once stays bounded.
PASS_CHARACTERS = 4_000_000


def contained(docs: DataFrame, id_col: str, text_col: str, phrases: DataFrame, phrase_id: str, phrase_col: str, pass_characters: int = PASS_CHARACTERS) -> DataFrame:
    """(id, found): for each text that contains a phrase the least id of those it contains; whole texts, whole phrases.

    Phrases are dealt by their hash to as many shards as their length asks for; each shard becomes one automaton, which
    reads a text once whatever the number of phrases. A null phrase is in no text, an empty one in every text that isn't
    null. No phrases or no texts give no rows.
    """
    some = phrases.select(F.col(phrase_id).alias("i"), F.col(phrase_col).alias("x")).where("x is not null and i is not null").groupBy("x").agg(F.min("i").alias("i"))
    total = some.agg(F.sum(F.length("x"))).first()[0] or 0
    shards, out = int(total) // pass_characters + 1, None
    kind = phrases.schema[phrase_id].dataType.simpleString()
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, found {kind}"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    for k in range(shards):
        shard = [(r["x"], r["i"]) for r in some.where(F.pmod(F.xxhash64("x"), F.lit(shards)) == k).collect()]
        shared = docs.sparkSession.sparkContext.broadcast(shard)

        def look(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            import ahocorasick

            automaton, anywhere = ahocorasick.Automaton(), [i for x, i in shared.value if x == ""]
            for x, i in shared.value:
                if x:
                    automaton.add_word(x, i)
            if len(automaton):
                automaton.make_automaton()
            for pdf in batches:
                hits = [min([*anywhere, *({i for _, i in automaton.iter(x)} if len(automaton) else ())], default=None) for x in pdf["text"]]
                keep = [h is not None for h in hits]
                yield pd.DataFrame({"id": pdf["id"][keep], "found": [h for h in hits if h is not None]})

        part = rows.mapInPandas(look, schema)
        out = part if out is None else out.unionByName(part)
    out = out if shards == 1 else out.groupBy("id").agg(F.min("found").alias("found"))
    return out.withColumnRenamed("id", id_col)


def families(docs: DataFrame, id_col: str, text_col: str, keywords: dict[str, list[str]], least: int = 1) -> DataFrame:
    """(id, family, score): how many of a family's keywords the lower-cased text contains, the best first by name."""
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    score = {k: sum((F.contains(low, F.lit(w)).cast("int") for w in words), F.lit(0)) for k, words in keywords.items()}
    best = F.array_max(F.array(*(F.struct(s.alias("score"), F.lit(-i).alias("place"), F.lit(k).alias("family")) for i, (k, s) in enumerate(score.items()))))
    return docs.select(F.col(id_col), best.alias("b")).select(id_col, F.when(F.col("b.score") >= least, F.col("b.family")).alias("family"), F.col("b.score").cast("long").alias("score"))


def sheet_families(books: DataFrame, id_col: str, sheets_col: str, text_col: str, keywords: dict[str, list[str]]) -> DataFrame:
    """(id, family, score) of every family that scores: 3 for a keyword that is a sheet's name or, with over two letters, part
    of one, and 1 for one of at least four letters in the text of its cells; case and space around don't count."""
    names = F.transform(F.coalesce(F.col(sheets_col), F.array().cast("array<string>")), lambda s: F.lower(F.trim(s)))
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))

    def points(w: str) -> Column:
        on_sheet = F.exists("_names", lambda s: (s == w) | (F.contains(s, F.lit(w)) if len(w) > 2 else F.lit(False)))
        return F.when(on_sheet, 3).otherwise(0) + (F.when(F.contains("_low", F.lit(w)), 1).otherwise(0) if len(w) >= 4 else F.lit(0))

    each = F.array(*(F.struct(F.lit(k).alias("family"), sum((points(w) for w in words), F.lit(0)).alias("score")) for k, words in keywords.items()))
    scored = books.select(F.col(id_col), names.alias("_names"), low.alias("_low")).select(id_col, F.explode(each).alias("_e"))
    return scored.select(id_col, "_e.family", F.col("_e.score").cast("long").alias("score")).where("score > 0")


def unfenced(text: str | Column) -> Column:
    """The text without a code fence around it."""
    text = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"^\s*```[a-z]*\n", ""), r"\n```\s*$", ""))


def answer_json(text: str | Column) -> Column:
    """The JSON that an answer holds: its last fenced block that can be read, the answer itself, or, where it was cut off,
    the whole pairs before the cut; null where there is none. Of equal keys the last counts."""

    @F.pandas_udf("string")
    def read(answers: pd.Series) -> pd.Series:
        from gridloom.functions.answers import answer

        return pd.Series([answer(x if isinstance(x, str) else None) for x in answers], index=answers.index, dtype=object)

    return read(text)


def salvaged(text: str | Column) -> Column:
    """The pairs of the JSON object in an answer, cut off or not, as a map of texts; nested values as JSON. Null where there
    is none."""
    return F.from_json(answer_json(text), "map<string,string>")


def slug(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
