"""Secret scans: base patterns, and two character Markov models, of random strings and of ordinary identifiers.

A run of characters is a secret by the models if the first makes it likelier than the second by more than a bound. All of
it is DataFrame operations: one scan takes matches and runs out of the texts, the models are counted from pairs of
characters, and scores are sums of whole thousandths of nats, so that no order of rows or sums changes them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import durable

#: Characters of runs.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
_CLASS = "[A-Za-z0-9+/_.=-]"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Where an assignment can begin, to pass over texts without one.
_KEY = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
#: Characters of an assigned value, at least; of a run that the models are fitted on; of a run that they judge.
LEAST_VALUE, LEAST_FITTED, LEAST_JUDGED = 6, 12, 16
RUN = f"(?<!{_CLASS}){_CLASS}{{{LEAST_FITTED},}}"
#: Thousandths of a nat by which a secret is likelier as a random string.
BOUND = 10_000
#: Strings of each made-up kind in the samples; weight of a character's overall frequency against that of pairs.
MADE_UP, PRIOR = 2000, 20.0
#: Characters that are scored at a time, so that long runs need no long arrays.
CHUNK = 1024


def _may_assign(text: Column) -> Column:
    return (F.contains(text, F.lit(":")) | F.contains(text, F.lit("="))) & text.rlike(_KEY)


def _matches(text: Column, pattern: str, there: Column, kept, value) -> Column:
    """Matches of pattern, leftmost first, as (gap before it, length, kept, value), where there are some."""
    cut = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, m: F.struct(F.length(gap).cast("long").alias("gap"), F.length(m).cast("long").alias("size"), kept(m).alias("kept"), value(m).alias("value")))
    none = F.array().cast("array<struct<gap:bigint,size:bigint,kept:boolean,value:string>>")
    return F.when(there, F.filter(cut, lambda x: x["size"].isNotNull())).otherwise(none)


def _scanned(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(_row, _id, and the matches of each kind, runs among them) of each document."""
    t, yes = F.coalesce(F.col("_text"), F.lit("")), lambda m: F.lit(True)
    long_enough = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= LEAST_VALUE
    # kept assignments are blanked before runs are taken, so a run never is a part of one
    blank = lambda gap, m: F.concat(gap, F.when(m.isNull(), "").when(long_enough(m), F.repeat(F.lit(" "), F.length(m))).otherwise(m))
    rest = F.array_join(F.zip_with(F.split(t, ASSIGN, -1), F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(0)), blank), "")
    free = F.when(_may_assign(t), rest).otherwise(t)
    own = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    assign = _matches(t, ASSIGN, _may_assign(t), long_enough, lambda m: F.regexp_extract(m, ASSIGN, 2))
    return own.select("_row", "_id", assign.alias("assign"), _matches(t, ACCESS, t.rlike(ACCESS), yes, lambda m: m).alias("access"), _matches(t, HEX, t.rlike(HEX), yes, lambda m: m).alias("hex"), _matches(free, RUN, F.lit(True), yes, lambda m: m).alias("markov"))


def _pairs(chunk: Column) -> Column:
    """Each two neighbours of a chunk's characters, the first one after a blank."""
    chars = F.split(chunk, "")
    return F.zip_with(F.concat(F.array(F.lit(" ")), F.slice(chars, 1, F.size(chars) - 1)), chars, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _chunks(value: Column) -> Column:
    return F.regexp_extract_all(value, F.lit(f".{{1,{CHUNK}}}"), F.lit(0))


def sample_of(scanned: DataFrame) -> DataFrame:
    """Labelled samples (value, random) out of scanned documents, each value once, and made-up random strings.

    Random: access keys, long hexadecimal numbers, assigned values that hold a digit. Ordinary: runs whose digits are four at
    most, at the end, and runs without letters. Other runs are in neither.
    """
    spark: SparkSession = scanned.sparkSession
    sure = F.concat("access", "hex", F.filter("assign", lambda x: x["kept"] & x["value"].rlike("[0-9]")))
    ordinary = F.filter("markov", lambda x: x["value"].rlike(r"^[A-Za-z+/_.=-]+[0-9]{0,4}$|^[0-9+/_.=-]+$"))
    values = lambda found, label: scanned.select(F.explode(F.transform(found, lambda x: x["value"])).alias("value"), F.lit(label).alias("random"))
    made = spark.range(MADE_UP)
    digest = lambda kind: F.sha2(F.concat(F.lit(f"{kind}:"), F.col("id").cast("string")).cast("binary"), 256)
    base = F.base64(F.unhex(digest("base64")))
    strings = made.select(F.explode(F.array(F.rtrim(base, F.lit("=")), F.upper(digest("hex")), F.regexp_replace(F.base64(F.unhex(digest("letters"))), "[+/=]", ""))).alias("value"), F.lit(True).alias("random"))
    return values(sure, True).unionByName(values(ordinary, False)).distinct().unionByName(strings)


def log_ratios(samples: DataFrame) -> list[int]:
    """For each pair of characters in order (a blank before the first): thousandths of nats by which it is likelier in random
    strings. samples: (value, random). The driver gets one count a pair and label, of 68 x 67 pairs."""
    pair = samples.where("value is not null and random is not null").select("random", F.explode(_chunks(F.col("value"))).alias("c")).select("random", F.explode(_pairs(F.col("c"))).alias("p"))
    known = lambda c: F.position(c, F.lit(ALPHABET)) > 0
    counts = {(r.random, r.a, r.b): r.n for r in pair.where(((F.col("p.a") == " ") | known(F.col("p.a"))) & known(F.col("p.b"))).groupBy("random", "p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).collect()}
    logs = {}
    for label in (True, False):
        one = {b: sum(counts.get((label, a, b), 0) for a in " " + ALPHABET) for b in ALPHABET}
        total = sum(one.values())
        overall = {b: (n + 1) / (total + len(ALPHABET)) for b, n in one.items()}
        for a in " " + ALPHABET:
            row = [counts.get((label, a, b), 0) for b in ALPHABET]
            for b, n in zip(ALPHABET, row, strict=True):
                logs[label, a, b] = math.log((n + PRIOR * overall[b]) / (sum(row) + PRIOR))
    return [math.floor(1000 * (logs[True, a, b] - logs[False, a, b]) + 0.5) for a in " " + ALPHABET for b in ALPHABET]


def score(value: Column, ratios: list[int]) -> Column:
    """Thousandths of nats by which a run is likelier as a random string; each chunk begins anew."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    place = lambda p: F.position(p["a"], F.lit(ALPHABET)) * len(ALPHABET) + F.position(p["b"], F.lit(ALPHABET))
    of_chunk = lambda c: F.aggregate(_pairs(c), F.lit(0).cast("long"), lambda s, p: s + F.element_at(table, place(p).cast("int")))
    return F.aggregate(F.transform(_chunks(value), of_chunk), F.lit(0).cast("long"), lambda s, x: s + x)


def find_secrets(docs: DataFrame, samples: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text", bound: int = BOUND) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of each document; spans: kind:start:end in code points, joined by
    commas, by start and then kind (assign, access, hex, markov).

    samples: (value, random), labelled strings; without them they are taken out of docs (see sample_of). A run that the models
    judge has 16 characters at least, lies outside the kept assignments and holds no access key and no long hexadecimal
    number. Texts are read whole; a null or empty text has no spans. Ids may be null or repeat: each row gives a row. No
    rows give no rows. Other columns, whatever their names, are left out. A text's matches are rows of their own while their
    places are summed, so long texts need no long arrays but those of their own matches.
    """
    scanned = durable(_scanned(docs, id_column, text_column), "secret-scan")
    ratios = log_ratios(sample_of(scanned) if samples is None else samples.select("value", F.col("random").cast("boolean").alias("random")))
    value = lambda x: x["value"]
    secret = lambda x: (F.length(value(x)) >= LEAST_JUDGED) & ~value(x).rlike(ACCESS) & ~value(x).rlike(HEX) & (score(value(x), ratios) > bound)
    slim = lambda kind, kept: F.transform(kind, lambda x: F.struct(x["gap"].alias("gap"), x["size"].alias("size"), kept(x).alias("kept")))
    judged = scanned.select("_row", "_id", *(slim(k, (lambda x: x["kept"]) if k != "markov" else secret).alias(k) for k in KINDS))
    judged = durable(judged.select("_row", "_id", F.array(*KINDS).alias("_found")).withColumn("_any", F.exists("_found", lambda a: F.exists(a, lambda x: x["kept"]))), "secret-runs")

    each = judged.where("_any").select("_row", "_id", F.posexplode("_found").alias("_kind", "_a")).select("_row", "_id", "_kind", F.posexplode("_a").alias("_at", "_m"))
    before = Window.partitionBy("_row", "_kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.withColumn("_end", F.sum(F.col("_m.gap") + F.col("_m.size")).over(before)).where("_m.kept").select("_row", "_id", "_kind", (F.col("_end") - F.col("_m.size")).alias("_start"), "_end")
    of = lambda k: F.count_if(F.col("_kind") == k)
    spans = placed.groupBy("_row", "_id").agg(of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sort_array(F.collect_list(F.struct("_start", "_kind", "_end"))).alias("_spans"))
    named = lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["_kind"] + 1), s["_start"].cast("string"), s["_end"].cast("string"))
    joined = lambda a: F.array_join(F.transform(a, named), ",")
    base = F.sha2(joined(F.filter("_spans", lambda s: s["_kind"] < 3)).cast("binary"), 256)
    some = spans.select(F.col("_id").alias(id_column), "n_assign", "n_access", "n_hex", base.alias("base_sha256"), joined(F.col("_spans")).alias("spans"))
    zero = F.lit(0).cast("long")
    none = judged.where("not _any").select(F.col("_id").alias(id_column), zero.alias("n_assign"), zero.alias("n_access"), zero.alias("n_hex"), F.sha2(F.lit("").cast("binary"), 256).alias("base_sha256"), F.lit("").alias("spans"))
    return some.unionByName(none)
