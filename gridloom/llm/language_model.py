"""Quality by perplexity: an interpolated modified Kneser-Ney character n-gram model of trusted text, by language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, look_up, may_contain, membership_filter, mix, null_key, ship_package, tidied

ORDER = 5
#: Entries of one shard of the model, which is what is broadcast at once (20 bytes each).
SHARD_ENTRIES = 1_500_000
#: A document is dropped if its adjusted perplexity is above this quantile of held-out trusted documents of its language,
#: times MARGIN. Adjusted means: with so many more characters of the language's mean, as short texts scatter more.
QUANTILE, MARGIN, MORE_CHARACTERS = 0.99, 1.1, 100
#: Identifiers of trusted documents that are broadcast, at most (8 bytes each); beyond, texts are joined to them by shuffle.
TRUSTED_IDS = 1 << 24
#: One in so many trusted documents is held out from counting, for the quantiles.
HELD_OUT = 10
BEGIN, END = "\x02", "\x03"
_K = mix(np.arange(1, 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def normalised(text: str | None) -> str:
    """White space as single spaces, case kept, without the marks that begin and end a document."""
    return " ".join((text or "").replace(BEGIN, " ").replace(END, " ").split())


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' characters, each after ORDER - 1 begin marks and with an end mark, and the text of each place."""
    lengths = np.array([len(t) + ORDER for t in texts], np.int64)
    joined = "".join([f"{BEGIN * (ORDER - 1)}{t}{END}" for t in texts])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), np.repeat(np.arange(len(texts)), lengths)


def _language_key(lang: str | None) -> np.uint64:
    x = np.uint64(1469598103934665603)
    with np.errstate(over="ignore"):
        for b in (lang if lang is not None else "\0").encode():
            x = (x ^ np.uint64(b)) * np.uint64(1099511628211)
    return x


def gram_keys(codes: np.ndarray, language: np.ndarray | np.uint64, n: int) -> np.ndarray:
    """A 64-bit key of the n characters that end at each place from ORDER - 1 on."""
    m = len(codes) - ORDER + 1
    x = np.full(m, _K[40 + n], np.uint64) + language
    for j in range(n):
        x += (codes[ORDER - 1 - j : ORDER - 1 - j + m].astype(np.uint64) + np.uint64(1)) * _K[j]
    return x


def count_grams(docs: DataFrame, ids: np.ndarray | None = None) -> DataFrame:
    """docs (lang, text, and id if ids are given): (lang, gram, n), n counting each run of ORDER characters.

    ids: ascending; only documents with one of them are counted. Each batch is summed up before the shuffle.
    """
    ship_package(docs.sparkSession)
    shared = None if ids is None else docs.sparkSession.sparkContext.broadcast(ids)  # at most TRUSTED_IDS

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import language_model as K

        for batch in batches:
            if shared is not None:
                own, held = batch.column(2).to_numpy(zero_copy_only=False), shared.value
                ok = np.isfinite(own) if own.dtype.kind == "f" else np.ones(len(own), bool)
                if own.dtype.kind == "f":  # some ids are null
                    own = batch.column(2).fill_null(0).to_numpy()
                at = np.minimum(np.searchsorted(held, own), len(held) - 1) if len(held) else np.zeros(len(own), np.int64)
                batch = batch.filter(pa.array(ok & (held[at] == own) if len(held) else np.zeros(len(own), bool)))
            if not batch.num_rows:
                continue
            langs, texts = batch.column(0).to_pylist(), batch.column(1)
            for lang in dict.fromkeys(langs):
                own = [K.normalised(t) for t, x in zip(texts.to_pylist(), langs, strict=True) if x == lang]
                codes, doc = K._codes(own)
                inside = doc[K.ORDER - 1 :] == doc[: len(doc) - K.ORDER + 1]
                key = K.gram_keys(codes, np.uint64(0), K.ORDER)[inside]
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                at = np.flatnonzero(inside)[first]
                chars = np.stack([codes[at + j] for j in range(K.ORDER)], axis=1).astype("<u4")
                grams = [bytes(row).decode("utf-32-le", "surrogatepass").encode("utf-8", "replace").decode() for row in chars]
                yield pa.record_batch([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    return docs.select("lang", "text", *(["id"] if ids is not None else [])).mapInArrow(tidied(count), "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _discounts(grams: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) of one order, from how many grams occur once to four times."""
    n = [F.count_if(F.col("n") == k).cast("double") for k in (1, 2, 3, 4)]
    y = n[0] / F.greatest(n[0] + 2 * n[1], F.lit(1.0))

    def d(k: int) -> Column:
        a, b = n[k - 1], n[k]
        return F.least(F.greatest(F.when(a > 0, k - (k + 1) * y * b / F.greatest(a, F.lit(1.0))).otherwise(F.lit(0.5 * k)), F.lit(0.05)), F.lit(k - 0.05))

    return grams.groupBy("lang").agg(d(1).alias("d1"), d(2).alias("d2"), d(3).alias("d3"))


def kneser_ney(top: DataFrame) -> DataFrame:
    """top (lang, gram, n) of ORDER characters: (lang, gram, logp, logbow) of all orders, null where there is none.

    Orders below the highest count how many different characters come before a gram. Each order's probability is
    (n - d) / total of the context + gamma(context) * that of the order below, d by n being 1, 2 or more; at the bottom
    all characters of the language and one unknown are alike. gram '' holds in logbow what an unknown character gets.
    """
    lang = F.col("lang")
    orders = {ORDER: top}
    for n in range(ORDER - 1, 0, -1):
        orders[n] = durable(orders[n + 1].groupBy("lang", F.substring("gram", 2, n).alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"grams-{n}", compression="zstd")
    lower, out = None, []
    for n in range(1, ORDER + 1):
        grams = look_up(orders[n].withColumn("_lang", null_key("lang")), durable(_discounts(orders[n]).withColumn("_lang", null_key("lang")).drop("lang"), "discounts"), "_lang", "gram").drop("_lang")
        grams = grams.withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))).withColumn("context", F.substring("gram", 1, n - 1) if n > 1 else F.lit(""))
        contexts = durable(grams.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("gamma"), F.count(F.lit(1)).alias("kinds")), f"contexts-{n}", compression="zstd")
        c = contexts.select(F.col("lang").alias("_l"), F.col("context").alias("_c"), "total", "gamma", "kinds")
        if n == 1:  # one row a language
            c = c.withColumn("_lang", null_key("_l")).drop("_l", "_c")
            grams = look_up(grams.withColumn("_lang", null_key("lang")), c, "_lang", "gram").withColumn("below", 1 / (F.col("kinds") + 1))
            out.append(contexts.select("lang", F.lit("").alias("gram"), F.lit(None).cast("double").alias("logp"), F.log(F.col("gamma") / (F.col("kinds") + 1)).alias("logbow")))
        else:
            low = lower.select(F.col("lang").alias("_l2"), F.col("gram").alias("_g2"), F.col("p").alias("below"))
            grams = grams.join(c, lang.eqNullSafe(F.col("_l")) & (F.col("context") == F.col("_c"))).join(low, lang.eqNullSafe(F.col("_l2")) & (F.substring("gram", 2, n - 1) == F.col("_g2")))
            out.append(contexts.select("lang", F.col("context").alias("gram"), F.lit(None).cast("double").alias("logp"), F.log("gamma").alias("logbow")))
        lower = durable(grams.select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("below")).alias("p")), f"probabilities-{n}", compression="zstd")
        out.append(lower.select("lang", "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("logbow")))
    whole = out[0]
    for x in out[1:]:
        whole = whole.unionByName(x)
    return whole.groupBy("lang", "gram").agg(F.max("logp").alias("logp"), F.max("logbow").alias("logbow"))


class Table:
    """Keys to (logp, logbow), NaN where there is none: open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray, logp: np.ndarray, logbow: np.ndarray) -> None:
        size = 16
        while size < 2 * len(keys) + 1:
            size *= 2
        self.mask = np.uint64(size - 1)
        self.keys, self.used = np.zeros(size, np.uint64), np.zeros(size, bool)
        self.values = np.full((size, 2), np.nan, np.float32)
        left, slot = np.arange(len(keys)), mix(keys) & self.mask
        while len(left):
            s = slot[left].astype(np.int64)
            free = ~self.used[s]
            first = np.zeros(len(left), bool)
            first[np.unique(s, return_index=True)[1]] = True
            put = free & first
            self.keys[s[put]], self.used[s[put]] = keys[left[put]], True
            self.values[s[put], 0], self.values[s[put], 1] = logp[left[put]], logbow[left[put]]
            left = left[~put]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask

    def find(self, keys: np.ndarray, column: int) -> np.ndarray:
        out = np.full(len(keys), np.nan, np.float32)
        left, slot = np.arange(len(keys)), (mix(keys) & self.mask).astype(np.int64)
        while len(left):
            s = slot[left]
            hit = self.used[s] & (self.keys[s] == keys[left])
            out[left[hit]] = self.values[s[hit], column]
            left = left[self.used[s] & ~hit]
            slot[left] = (slot[left] + 1) & int(self.mask)
        return out


def score_batch(table: Table, unknown: dict, shard: int, shards: int, langs: list, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(log probability, characters) of each text: those characters whose previous one belongs to the shard."""
    codes, doc = _codes(texts)
    languages = np.array([_language_key(x) for x in langs], np.uint64)[doc][ORDER - 1 :]
    inside = doc[ORDER - 1 :] == doc[: len(doc) - ORDER + 1]
    if shards > 1:
        inside &= mix(codes[ORDER - 2 : len(codes) - 1].astype(np.uint64) + languages) % np.uint64(shards) == shard
    at = np.flatnonzero(inside)
    keys = {n: gram_keys(codes, languages, n)[at] for n in range(1, ORDER + 1)}
    before = {n: gram_keys(np.concatenate([[0], codes[:-1]]), languages, n)[at] for n in range(1, ORDER)}
    own, total, left = doc[ORDER - 1 :][at], np.zeros(len(at)), np.arange(len(at))
    for n in range(ORDER, 0, -1):
        p = table.find(keys[n][left], 0)
        hit = ~np.isnan(p)
        total[left[hit]] += p[hit]
        left = left[~hit]
        if not len(left):
            break
        if n > 1:
            total[left] += np.nan_to_num(table.find(before[n - 1][left], 1))
    if len(left):
        rest = np.array([unknown.get(x, 0.0) for x in langs])
        total[left] += rest[own[left]]
    return np.bincount(own, weights=total, minlength=len(texts)), np.bincount(own, minlength=len(texts))


def perplexities(docs: DataFrame, model: DataFrame, id_col: str, text_col: str, lang_col: str, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """(key, lang, n_tokens, perplexity); perplexity is null where the language has no model.

    The model is cut into shards of bounded size by the character before the last; all that a character's probability
    needs is in one shard, but for single characters, which every shard holds. Documents pass one shard after another,
    and what each gives is added up, so neither model nor text has to fit in a task.
    """
    spark, n = docs.sparkSession, model.count()
    shards = -(-n // shard_entries) or 1

    def keyed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import language_model as K

        for batch in batches:
            langs, grams = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            codes, ends = K._codes(grams)[0], np.cumsum([len(g) + K.ORDER for g in grams]) - 2
            languages, sizes = np.array([K._language_key(x) for x in langs], np.uint64), np.array([len(g) for g in grams])
            key, last = np.zeros(len(grams), np.uint64), codes[ends].astype(np.uint64)
            for size in range(1, K.ORDER + 1):
                own = np.flatnonzero(sizes == size)
                x = np.full(len(own), K._K[40 + size], np.uint64) + languages[own]
                for j in range(size):
                    x += (codes[ends[own] - j].astype(np.uint64) + np.uint64(1)) * K._K[j]
                key[own] = x
            for column, places in ((2, ends - 1), (3, ends)):  # a gram's own shard, and its shard as a context
                some = ~np.array(batch.column(column).is_null())
                shard = (K.mix(codes[places].astype(np.uint64) + languages) % np.uint64(shards)).astype(np.int64)
                shard[(sizes == 1) & (column == 2)] = -1
                value = batch.column(column).to_numpy(zero_copy_only=False)
                yield pa.record_batch([pa.array(x[some]) for x in (key.astype(np.int64), shard, value if column == 2 else np.full(len(value), np.nan), value if column == 3 else np.full(len(value), np.nan))], names=["key", "shard", "logp", "logbow"])

    entries = model.where("gram <> ''").mapInArrow(keyed, "key long, shard long, logp double, logbow double")
    best = [F.max(F.nanvl(c, F.lit(None))).cast("float").alias(c) for c in ("logp", "logbow")]  # a gram has one row for each
    table = durable(entries.groupBy("shard", "key").agg(*best), "model", compression="zstd")
    unknown = {r["lang"]: r["logbow"] for r in model.where("gram = ''").collect()}  # one number a language
    rows = docs.select(F.col(id_col).alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.lit(0.0).alias("logp"), F.lit(0).cast("long").alias("n"))
    for k in range(shards):
        # at most shard_entries of 16 bytes, and single characters; a key may be in both with a value in each
        part = table.where(F.col("shard").isin(k, -1)).groupBy("key").agg(F.max("logp").alias("logp"), F.max("logbow").alias("logbow")).toArrow()
        keys, values = part.column(0).to_numpy().view(np.uint64), np.stack([part.column(c).to_numpy() for c in (1, 2)], 1)
        shared = spark.sparkContext.broadcast((keys, values, unknown, k))
        del part, keys, values

        def score(batches: Iterator, shared=shared) -> Iterator:
            import pyarrow as pa

            from gridloom.llm import language_model as K

            keys, values, rest, shard = shared.value
            found = K.Table(keys, values[:, 0], values[:, 1])
            for batch in batches:
                langs, texts = batch.column(1).to_pylist(), [K.normalised(t) for t in batch.column(2).to_pylist()]
                logp, n, i = np.zeros(len(texts)), np.zeros(len(texts), np.int64), 0
                size = np.cumsum([len(t) + K.ORDER for t in texts])
                while i < len(texts):  # a million characters at a time
                    j = max(i + 1, int(np.searchsorted(size, size[i] + 1_000_000)))
                    logp[i:j], n[i:j] = K.score_batch(found, rest, shard, shards, langs[i:j], texts[i:j])
                    i = j
                yield pa.record_batch([*batch.columns[:3], pa.array(batch.column(3).to_numpy() + logp), pa.array(batch.column(4).to_numpy() + n)], names=["key", "lang", "text", "logp", "n"])

        rows = rows.mapInArrow(tidied(score), rows.schema)
    modelled = F.coalesce(F.col("lang"), F.lit("\0")).isin([k if k is not None else "\0" for k in unknown] or ["\1"])
    return rows.select("key", "lang", F.col("n").alias("n_tokens"), F.when(modelled, F.exp(-F.col("logp") / F.col("n"))).alias("perplexity"))


def perplexity_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, margin: float = MARGIN, shard_entries: int = SHARD_ENTRIES, trusted_ids: int = TRUSTED_IDS) -> DataFrame:
    """One row per input row: id, lang, n_tokens (characters and the end), perplexity, adjusted, threshold, kept.

    Trusted documents are those labelled quality 1 and not toxic; all of them are counted but one in HELD_OUT, whose
    perplexities give the quantiles, so what the model holds grows with them. White space is collapsed, a null text is
    empty. adjusted is the perplexity with MORE_CHARACTERS characters of the language's held-out mean besides its own;
    a document is kept if that is at most threshold. Documents of a language without trusted text have neither perplexity
    nor threshold and are kept, as are those of a language without held-out ones; null is a language of its own. Repeated
    rows and null ids are scored like others; an empty table gives no rows; other columns play no part.
    """
    trusted = durable(labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct().withColumn("key", F.xxhash64("doc_id")).withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(HELD_OUT)) == 0), "trusted")
    n, texts = trusted.count(), docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    if n <= trusted_ids and all(t.typeName() in ("byte", "short", "integer", "long") for t in (docs.schema[id_col].dataType, labels.schema["doc_id"].dataType)):
        ids = np.sort(trusted.where("not held").select(F.col("doc_id").cast("long")).toArrow().column(0).to_numpy())
        grams = count_grams(texts.withColumn("id", F.col("id").cast("long")), ids)
    else:
        some = may_contain(texts.withColumn("key", F.xxhash64("id")), "key", membership_filter(trusted, "key", n))
        grams = count_grams(some.join(trusted.where("not held").select(F.col("doc_id").alias("id")), "id", "left_semi"))
    model = durable(kneser_ney(durable(grams, "grams", compression="zstd")), "kneser-ney", compression="zstd")
    scored = durable(perplexities(docs, model, id_col, text_col, lang_col, shard_entries), "perplexities", compression="zstd").withColumn("_lang", null_key("lang"))

    held = durable(scored.where("perplexity is not null").join(trusted.where("held").select(F.col("doc_id").alias("key")), "key", "left_semi"), "held-out", compression="zstd")
    means = durable(held.groupBy("_lang").agg(F.avg(F.log("perplexity")).alias("mean")), "means")
    n_tokens, mean = F.col("n_tokens"), F.col("mean")
    adjusted = F.exp((F.log("perplexity") * n_tokens + mean * MORE_CHARACTERS) / (n_tokens + MORE_CHARACTERS))
    limits = look_up(held, means, "_lang", "key").groupBy("_lang").agg((F.percentile_approx(adjusted, quantile, 10_000) * margin).alias("threshold"))
    every = scored.select("_lang").distinct().join(means, "_lang", "left").join(limits, "_lang", "left")
    out = look_up(scored, durable(every, "quantiles"), "_lang", "key").withColumn("adjusted", adjusted).withColumn("threshold", F.when(F.col("perplexity").isNotNull(), F.col("threshold")))
    return out.select(F.col("key").alias(id_col), "lang", "n_tokens", "perplexity", "adjusted", "threshold", F.coalesce(F.col("adjusted") <= F.col("threshold"), F.lit(True)).alias("kept"))
