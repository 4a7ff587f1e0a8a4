"""Values as they are typed or shown: numbers with currencies, brackets and percents, dates, truth values, texts; and which
of them repeat a value that is masked."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import settled

#: How a number is shown, and patterns of dates.
_NUMBER = r"([-+]?(?:[0-9]{1,3}(?:[,\s][0-9]{3})+|[0-9]+)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)\s*(%?)\s*"
_BEFORE, _AFTER = r"^\s*(?:[A-Z]{3}\s*|[$€£]\s*)?", r"(?:\s*[A-Za-z][A-Za-z0-9 ./()_-]*)?\s*$"
SHOWN, BRACKETED = _BEFORE + _NUMBER + _AFTER, _BEFORE + r"\(\s*" + _NUMBER + r"\)" + _AFTER
DATES = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy")
#: Fixed value: a number inside prose.
IN_PROSE = r"(?<![A-Za-z0-9.])[-+]?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?%?(?![A-Za-z0-9.])"
#: First words of phrases that are broadcast; with more, texts' words are all shuffled.
MOST_FIRSTS = 1_000_000
#: Numbers agree within this part of the larger one, and absolutely below 1.
NEAR = 1e-9


def shown_numbers(text: Column | str) -> Column:
    """The numbers that a text which is one number stands for: with a percent sign also its hundredth; in brackets less than
    nothing. Empty for other texts."""
    text = F.col(text) if isinstance(text, str) else text
    got = lambda p, i: F.regexp_extract(text, p, i)
    plain = F.regexp_replace(got(SHOWN, 1), r"[,\s]", "").try_cast("double")
    held = -F.abs(F.regexp_replace(got(BRACKETED, 1), r"[,\s]", "").try_cast("double"))
    number, sign = F.coalesce(plain, held), F.when(plain.isNotNull(), got(SHOWN, 2)).otherwise(got(BRACKETED, 2))
    return F.coalesce(F.when(number.isNull(), F.array().cast("array<double>")).when(sign == "%", F.array(number, number / 100)).otherwise(F.array(number)), F.array().cast("array<double>"))


def shown_date(text: Column | str) -> Column:
    """The day that a text names, by the first of the patterns that it follows."""
    text = F.trim(F.col(text) if isinstance(text, str) else text)
    # only texts that can be dates are parsed
    return F.when(text.rlike(r"^[0-9A-Za-z]{1,4}[-/ ][0-9A-Za-z]{1,3},?[-/ ][0-9]{1,4}$"), F.coalesce(*(F.try_to_timestamp(text, F.lit(p)).cast("date") for p in DATES)))


def normal(text: Column) -> Column:
    """A text without case and with single spaces."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _cell(x: Column, around: bool) -> Column:
    """Keys of a number such that numbers which agree share one: a grid below 1, a grid of logarithms above; around: also
    the neighbours', and both grids near 1."""
    size, step = F.abs(x), 4 * NEAR
    near = (-1, 0, 1) if around else (0,)
    low = [F.concat(F.lit("n|"), (F.floor(x / step) + i).cast("string")) for i in near]
    high = [F.concat(F.lit("l|"), F.signum(x).cast("int").cast("string"), F.lit("|"), (F.floor(F.log(F.greatest(size, F.lit(0.5))) / step) + i).cast("string")) for i in near]
    if around:
        return F.when(size < 0.99, F.array(*low)).when(size > 1.01, F.array(*high)).otherwise(F.array(*low, *high))
    return F.when(size <= 1, F.array(*low)).otherwise(F.array(*high))


def _forms(kind: Column, number: Column, text: Column, day: Column, around: bool) -> Column:
    """What a value says, as (key, number) pairs; a text may be a number, a date, a truth value and a text at once."""
    pair = lambda key, x: F.struct(key.alias("key"), x.cast("double").alias("x"))
    none, is_text = F.lit(None), kind == "text"
    date = F.coalesce(day, F.when(is_text, shown_date(text)))
    # a masked value that is a text is a text; only what may repeat it is read as a number
    numbers = F.when(kind == "num", F.array(number)).when(is_text & F.lit(around), shown_numbers(text)).otherwise(F.array().cast("array<double>"))
    keys = F.flatten(F.transform(F.filter(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)), lambda x: F.transform(_cell(x, around), lambda k: pair(k, x))))
    truth = F.when(kind == "bool", F.concat(F.lit("b|"), F.when(number != 0, "true").otherwise("false")))
    if around:
        truth = F.coalesce(truth, F.when(is_text & normal(text).isin("true", "false"), F.concat(F.lit("b|"), normal(text))))
    said = F.when(is_text & (normal(text) != "") & (F.lit(around) | date.isNull()), F.concat(F.lit("s|"), normal(text)))
    rest = F.array_compact(F.array(*(F.when(k.isNotNull(), pair(k, none)) for k in (truth, F.concat(F.lit("d|"), date.cast("string")), said))))
    return F.concat(F.coalesce(keys, F.array().cast("array<struct<key:string,x:double>>")), rest)


def value_leaks(values: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """(by, id, target): values that say what a masked value of the same group does, as a number, date, truth value or text.

    values and targets: (by, id, kind, number, text, day); kind: num, bool (number not 0), date or text. Each side carries
    what it may say as keys, so nothing is compared but what shares one; numbers that meet are then compared.
    """
    forms = lambda df, around: df.withColumn("_f", F.explode(_forms(F.col("kind"), F.col("number"), F.col("text"), F.col("day"), around)))
    left = forms(values, True).select(*by, "id", F.col("_f.key").alias("_key"), F.col("_f.x").alias("_x"))
    right = forms(targets, False).select(*by, F.col("id").alias("target"), F.col("_f.key").alias("_key"), F.col("_f.x").alias("_y"))
    agree = F.col("_x").isNull() | (F.abs(F.col("_x") - F.col("_y")) <= NEAR * F.greatest(F.lit(1.0), F.abs("_x"), F.abs("_y")))
    return left.join(right, [*by, "_key"]).where(agree).select(*by, "id", "target").distinct()


def prose_numbers(text: Column | str) -> Column:
    """The numbers of a prose text that stand apart from letters and digits; of a percentage also its hundredth."""
    text = F.col(text) if isinstance(text, str) else text
    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(IN_PROSE), F.lit(0)), shown_numbers))


def prose_leaks(texts: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """(by, id, target): texts that contain a masked number, day (as year-month-day), truth value or phrase as a whole word.

    texts: (by, id, text); targets as in value_leaks. Numbers and days are taken out of the texts and met by key; a phrase is
    looked for only in texts of its group that hold its first word.
    """
    number = F.transform(F.filter(prose_numbers("text"), lambda x: x.isNotNull() & (F.abs(x) < math.inf)), lambda x: F.struct(_cell(x, True).alias("keys"), x.alias("x")))
    found = texts.select(*by, "id", F.explode(number).alias("_n")).select(*by, "id", F.explode("_n.keys").alias("_key"), F.col("_n.x").alias("_x"))
    days = texts.select(*by, "id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.lit(0)))).alias("_key")).select(*by, "id", F.concat(F.lit("d|"), "_key").alias("_key"), F.lit(None).cast("double").alias("_x"))
    right = targets.withColumn("_f", F.explode(_forms(F.col("kind"), F.col("number"), F.col("text"), F.col("day"), False))).select(*by, F.col("id").alias("target"), F.col("_f.key").alias("_key"), F.col("_f.x").alias("_y")).where(~F.col("_key").startswith("s|") & ~F.col("_key").startswith("b|"))
    agree = F.col("_x").isNull() | (F.abs(F.col("_x") - F.col("_y")) <= NEAR * F.greatest(F.lit(1.0), F.abs("_x"), F.abs("_y")))
    out = found.unionByName(days).join(right, [*by, "_key"]).where(agree).select(*by, "id", "target")

    phrase = F.lower(F.trim(F.when(F.col("kind") == "bool", F.when(F.col("number") != 0, "true").otherwise("false")).when((F.col("kind") == "text") & shown_date("text").isNull(), F.col("text"))))
    words = lambda c: F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    first = F.coalesce(F.get(words(F.col("_p")), F.lit(0)), F.lit(""))
    wanted = targets.withColumn("_p", phrase).where("_p <> ''").select(*by, F.col("id").alias("target"), "_p", first.alias("_w"))
    # a phrase without words can stand anywhere: its key is the empty word, which every text has
    wanted = settled(wanted)
    firsts = settled(wanted.select("_w").distinct())
    held = texts.select(*by, "id", F.lower("text").alias("_t")).withColumn("_w", F.explode(F.array_append(F.array_distinct(words(F.col("_t"))), F.lit(""))))
    # words that begin no phrase of any group are left out before the shuffle, if those that do fit every task
    few = firsts.count() <= MOST_FIRSTS
    held = (held.join(F.broadcast(firsts), "_w", "left_semi") if few else held).join(wanted, [*by, "_w"])
    edge = r"(?<![\p{L}\p{N}_])%s(?![\p{L}\p{N}_])"
    quoted = F.concat(F.lit(edge.split("%s")[0] + r"\Q"), F.replace(F.col("_p"), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E" + edge.split("%s")[1]))
    return out.unionByName(held.where(F.contains("_t", F.col("_p")) & F.regexp_like("_t", quoted)).select(*by, "id", "target")).distinct()
