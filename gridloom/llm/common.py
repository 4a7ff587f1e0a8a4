"""Shared plumbing: shared-folder tables, package shipping, a bounded membership filter and fast text kernels."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of 64 bits in a membership filter: what is broadcast stays below 2**18 rows of two longs (about 10 MB).
MAX_FILTER_WORDS = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a local one only where none is set and Spark is local."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    own = getattr(spark.sparkContext, "_gridloom_dir", None)
    if own is None:
        own = spark.sparkContext._gridloom_dir = "file://" + tempfile.mkdtemp(prefix="gridloom-")
    return own


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gridloom-{name}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame, name: str, tasks: int | None = None, **options: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read back: cuts lineage and outlives lost executors.

    tasks: the most tasks that the last step is worth, where its rows are known to be few.
    """
    if tasks is not None:
        df = df.coalesce(max(1, tasks))
    spark, path = df.sparkSession, new_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Sends this package to Python workers, once a context, so that they import it wherever the driver started."""
    if getattr(spark.sparkContext, "_gridloom_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    if not root.is_dir():  # already imported from a zip
        return
    out = Path(tempfile.mkdtemp(prefix="gridloom-code-")) / "gridloom_code.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(out))
    spark.sparkContext._gridloom_shipped = True


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted names, each after as many underscores as make it unlike any taken one; Spark takes no heed of case."""
    held, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in held:
            name = "_" + name
        held.add(name.lower())
        out.append(name)
    return out


def null_key(c: Column | str) -> Column:
    """A string key in which null is a value of its own, unlike any text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def _filter_mask(key: Column) -> Column:
    one, mask = F.lit(1).cast("long"), F.lit(0).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(key, 24 + 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")) for i in range(4)]
    for b in bits:
        mask = mask.bitwiseOR(b)
    return mask


def membership_filter(keys: DataFrame, key: str, n_keys: int) -> DataFrame:
    """A Bloom filter over 64-bit keys as rows (slot, word), each key with four bits in one word.

    Its size is bounded by MAX_FILTER_WORDS whatever n_keys is: beyond that it lets more rows through and stays right.
    """
    n = 64
    while n < MAX_FILTER_WORDS and n * 4 < n_keys:
        n *= 2
    slot = F.col(key).bitwiseAND(F.lit(n - 1).cast("long")).alias("_slot")
    words = keys.select(slot, _filter_mask(F.col(key)).alias("_mask")).groupBy("_slot").agg(F.bit_or("_mask").alias("_word"))
    words._gridloom_slots = n
    return words


def flag_by_filter(df: DataFrame, key: str, words: DataFrame, flag: str) -> DataFrame:
    """df with a column flag: whether its key may be in the filter. No row is lost or shuffled."""
    n, (slot, word) = words._gridloom_slots, free_names([*df.columns, flag], "slot", "word")
    table = words.select(F.col("_slot").alias(slot), F.col("_word").alias(word))
    both = df.withColumn(slot, F.col(key).bitwiseAND(F.lit(n - 1).cast("long"))).join(F.broadcast(table), slot, "left")
    inside = F.coalesce(F.col(word).bitwiseAND(_filter_mask(F.col(key))) == _filter_mask(F.col(key)), F.lit(False))
    return both.withColumn(flag, inside).drop(slot, word)


def may_contain(df: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """The rows of df whose key may be in the filter; none that is in it is lost."""
    return split_by_filter(df, key, words)[0]


def split_by_filter(df: DataFrame, key: str, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be in the filter, all other rows), as two reads of df, without a shuffle."""
    (flag,) = free_names(df.columns, "inside")
    both = flag_by_filter(df, key, words, flag)
    return both.where(F.col(flag)).drop(flag), both.where(~F.col(flag)).drop(flag)


#: Rows of a lookup table that may be broadcast, and parts into which a key's rows are dealt beyond.
MAX_LOOKUP_ROWS, LOOKUP_SALTS = 10_000, 64


def look_up(rows: DataFrame, table: DataFrame, key: str, spread_by: str) -> DataFrame:
    """rows joined to a table with one row a key: by broadcast if it is small, else by key and salt, so no key is hot."""
    if table.count() <= MAX_LOOKUP_ROWS:
        return rows.join(F.broadcast(table), key)
    (salt,) = free_names([*rows.columns, *table.columns], "salt")
    salted = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1))))
    return rows.withColumn(salt, F.pmod(F.xxhash64(spread_by), F.lit(LOOKUP_SALTS)).cast("int")).join(salted, [key, salt]).drop(salt)


# --- numpy text kernels -------------------------------------------------------------------------------------------

#: Odd multipliers of two independent hashes, and their inverses modulo 2**64.
_MULTIPLIERS = [(np.uint64(m), np.uint64(pow(m, -1, 1 << 64))) for m in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Splits nearby 64-bit values apart (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64, have: list[np.ndarray]) -> np.ndarray:
    """have: holds the longest array of powers made so far."""
    if not have or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        p = np.full(size, base, np.uint64)
        p[0] = 1
        have[:] = [np.multiply.accumulate(p)]
    return have[0][:n]


_UP: list[list[np.ndarray]] = [[], []]
_DOWN: list[list[np.ndarray]] = [[], []]


def tidied(run):
    """run, a worker's function from batches to batches, that gives memory back to the machine when a task ends.

    Idle workers stay for the next tasks; what the allocators keep of a task's arrays would add up over them.
    """

    def tidy(batches):
        import ctypes
        import gc

        import pyarrow as pa

        from gridloom.llm import common as C

        try:
            yield from run(batches)
        finally:
            for have in (*C._UP, *C._DOWN):
                have.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return tidy


class Batch:
    """Texts of an Arrow array (null: empty) as bytes: data, and where each begins and ends."""

    def __init__(self, column) -> None:
        import pyarrow as pa
        import pyarrow.compute as pc

        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column, "").cast(pa.large_string())
        n = len(column)
        buffers = column.buffers()
        at = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(buffers[2], np.uint8) if n and buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
        self.data, self.at = raw[at[0] : at[-1]], at - at[0]
        self.n = n

    def parts(self, most: int = 1 << 20):
        """Batches of about most bytes, so that arrays a few times the text stay small; a longer text stands alone."""
        i = 0
        while i < self.n:
            j = max(i + 1, int(np.searchsorted(self.at, self.at[i] + most, "right")) - 1)
            out = Batch.__new__(Batch)
            out.data, out.at, out.n = self.data[self.at[i] : self.at[j]], self.at[i : j + 1] - self.at[i], j - i
            yield i, out
            i = j


def words_of(batch: Batch, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, document, 64-bit hash) of every word `[^\\x20\\x09-\\x0D]+`; document: ascending."""
    data = batch.data
    if not len(data):
        e = np.zeros(0, np.int64)
        return e, e, e, np.zeros(0, np.uint64)
    solid = ~_SPACE[data]
    step = np.empty(len(data), bool)
    step[0] = solid[0]
    np.logical_and(solid[1:], ~solid[:-1], out=step[1:])
    firsts = batch.at[:-1][(batch.at[1:] > batch.at[:-1])]
    step[firsts] = solid[firsts]
    begin = np.flatnonzero(step)
    last = np.empty(len(data), bool)
    last[-1] = solid[-1]
    np.logical_and(solid[:-1], ~solid[1:], out=last[:-1])
    ends = batch.at[1:][(batch.at[1:] > batch.at[:-1])] - 1
    last[ends] = solid[ends]
    end = np.flatnonzero(last) + 1
    doc = np.searchsorted(batch.at, begin, "right") - 1
    return begin, end, doc, span_hashes(_LOWER[data] if lower else data, begin, end)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's bytes; which: 0 or 1, two independent ones."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    up, down = _MULTIPLIERS[which]
    value = (data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), up, _UP[which])
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    raw = (total[end] - total[begin]) * _powers(len(data), down, _DOWN[which])[np.minimum(begin, len(data) - 1)]
    return mix(raw + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position of the first word, document, hash) of each run of n words inside one document."""
    if len(h) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(h) - n + 1
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    x = np.zeros(len(at), np.uint64)
    for i in range(n):
        x = mix(x * np.uint64(0xFF51AFD7ED558CCD) + h[at + i] + np.uint64(i + 1))
    return at, doc[at], x


# --- skew-safe joins ----------------------------------------------------------------------------------------------

#: A group with over 1/HOT_GROUPS of all rows is one of at most HOT_GROUPS, so such groups can be broadcast.
HOT_GROUPS = 4096


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int, unique: str) -> DataFrame:
    """rows left-joined to groups (one row a key; size: its number of rows) without piling a hot key up on one task.

    Hot groups are joined by broadcast, the others by key; rows of hot groups then carry a key that meets nothing, made
    from the column unique. key must be binary and not null in rows.
    """
    limit, payload = max(1, n_rows // HOT_GROUPS), [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) > limit).select(key, F.struct(*payload).alias("_hot"))
    cold = groups.where(F.col(size) <= limit).select(F.col(key).alias("_key"), F.struct(*payload).alias("_cold"))
    out = rows.join(F.broadcast(hot), key, "left")
    out = out.withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(F.encode(F.concat(F.lit("hot"), F.col(unique).cast("string")), "UTF-8")))
    out = out.join(cold, "_key", "left").withColumn("_group", F.coalesce("_hot", "_cold"))
    return out.select(*rows.columns, *(F.col("_group")[c].alias(c) for c in payload))
