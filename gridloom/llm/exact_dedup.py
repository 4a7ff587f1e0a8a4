"""Exact deduplication by a log-structured merge index, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, flag_by_filter, free_names, may_contain, membership_filter, new_dir

#: Groups above this share of the rows are joined by broadcast: there are at most HOT_GROUPS of them, whatever the input.
HOT_GROUPS = 4096
#: Runs of a level that compaction merges into one of the next, and that may be left unmerged.
FAN_IN = 4


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


class MergeIndex:
    """Sorted runs of (digest, smallest and largest row, count) that are merged level by level.

    A memtable holds the rows of one task, which spark.sql.files.maxPartitionBytes bounds; flush() writes each as a run of
    level 0, sorted by digest, with a Parquet Bloom filter on the digest, without a shuffle. compact() merges each FAN_IN
    runs of a level into one of the next and keeps the smallest and the largest row of a digest, all runs of a level in
    one job. hits() probes the few runs that are left through bounded filters, so only digests that two runs may share are
    brought together. Every table is in the shared folder.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, fan_in: int = FAN_IN) -> None:
        self.spark, self.path, self.fan_in = spark, path or new_dir(spark, "merge-index"), fan_in
        #: For each level the tables written, and how many runs they hold together; runs are numbered over the level.
        self.levels: list[tuple[list[str], int]] = [([], 0)]
        self._written: list[str] = []

    def _write(self, table: DataFrame, level: int) -> None:
        path = f"{self.path}/level-{level}-{len(self._written)}"
        options = {"parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.adaptive.enabled": "true", "compression": "zstd"}
        table.sortWithinPartitions("run", "digest").write.options(**options).parquet(path)
        self._written.append(path)
        while len(self.levels) <= level:
            self.levels.append(([], 0))
        last = self.spark.read.parquet(path).agg(F.max("run")).first()[0]
        paths, n = self.levels[level]
        self.levels[level] = ([*paths, path], n if last is None else max(n, last + 1))

    def flush(self, rows: DataFrame) -> DataFrame:
        """rows: (digest, row) and any other columns; returns them as they were written."""
        self._write(rows.withColumn("run", F.spark_partition_id() + F.lit(self.levels[0][1])), 0)
        return self.spark.read.parquet(self._written[-1]).select(*rows.columns)

    def _level(self, level: int) -> DataFrame:
        table = self.spark.read.parquet(*self.levels[level][0])
        if level:
            return table
        return table.select("run", "digest", F.col("row").alias("smallest"), F.col("row").alias("largest"), F.lit(1).cast("long").alias("n"))

    @staticmethod
    def _merge(entries: DataFrame, *by: Column | str) -> DataFrame:
        return entries.groupBy(*by, "digest").agg(F.min("smallest").alias("smallest"), F.max("largest").alias("largest"), F.sum("n").alias("n"))

    def compact(self, level: int = 0) -> None:
        """Merges the runs of one level, FAN_IN by FAN_IN, into runs of the next."""
        if self.levels[level][1]:
            first = self.levels[level + 1][1] if level + 1 < len(self.levels) else 0
            merged = self._merge(self._level(level), (F.floor(F.col("run") / self.fan_in) + first).cast("int").alias("run"))
            self._write(merged, level + 1)
            self.levels[level] = ([], 0)

    def settle(self) -> None:
        """Compacts until no level has more than FAN_IN runs."""
        level = 0
        while level < len(self.levels):
            if self.levels[level][1] > self.fan_in:
                self.compact(level)
            level += 1

    def runs(self) -> int:
        return sum(n for _, n in self.levels)

    def entries(self) -> DataFrame:
        """(run, digest, smallest, largest, n) of all runs; a digest may be in several."""
        out = None
        for level, (paths, _) in enumerate(self.levels):
            if paths:
                own = self._level(level).withColumn("run", F.col("run") + (level << 20))
                out = own if out is None else out.unionByName(own)
        return out

    def hits(self) -> DataFrame:
        """(digest, smallest, largest, n) of every digest with n > 1 over all runs."""
        self.settle()
        entries = self.entries().withColumn("key", F.xxhash64("digest"))
        sizes = {r["run"]: r["n"] for r in entries.groupBy("run").agg(F.count(F.lit(1)).alias("n")).collect()}  # FAN_IN a level at most
        shared, probed = F.lit(False), entries
        for run, n in sorted(sizes.items()) if len(sizes) > 1 else []:
            (flag,) = free_names(probed.columns, "held")
            probed = flag_by_filter(probed, "key", membership_filter(entries.where(F.col("run") == run), "key", n), flag)
            shared = shared | (F.col(flag) & (F.col("run") != run))
        probed = probed.withColumn("shared", shared)
        met = self._merge(probed.where("shared"))
        alone = probed.where("not shared").select(*met.columns)
        # a run of level 0 may hold a digest more than once
        return met.unionByName(self._merge(alone) if self.levels[0][1] else alone).where("n > 1")

    def lookup(self, digests: list[bytes]) -> DataFrame:
        """The entries of a few digests; Parquet's filters skip row groups that hold none."""
        return self._merge(self.entries().where(F.col("digest").isin([F.lit(bytearray(d)) for d in digests])))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", fan_in: int = FAN_IN, digest=_digest) -> DataFrame:
    """One row per input row: id, keep_id (the row that stays of its equal texts), group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. keep: 'smallest' or 'largest' id stays. Of repeated
    rows (same id and text) one is kept. A null id orders before all others. An empty table gives no rows. Digests only
    propose equality: every text whose digest occurs twice is grouped by its bytes, and texts that share a digest but
    differ are told apart by a join on the text itself. digest: column -> column; tests pass a weak one.

    A copy costs one row of (digest, row) in the shuffle; texts are shuffled only where the digest occurs again, after
    map-side grouping, so that a group with a third of all rows moves one text per task.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    text = F.coalesce(F.col(text_col), F.lit(""))
    index = MergeIndex(spark, fan_in=fan_in)
    log = index.flush(docs.select(F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("uid")).alias("row"), digest(F.col(text_col)).alias("digest"), F.unhex(F.sha2(text, 256)).alias("sha")))
    hits = durable(index.hits().withColumn("key", F.xxhash64("digest")), "dedup-hits", compression="zstd")
    n_rows, n_hits = log.count(), hits.count()

    words = membership_filter(hits, "key", n_hits)
    found = docs.select(text.alias("text"), digest(F.col(text_col)).alias("digest"), F.col(id_col).alias("id"))
    found = may_contain(found.withColumn("key", F.xxhash64("digest")), "key", words)
    by_bytes = durable(found.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n")).select("digest", F.unhex(F.sha2("text", 256)).alias("sha"), "n", F.length("text").alias("len")), "dedup-verified", compression="zstd")
    twins = by_bytes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    if twins.isEmpty():  # every digest stands for one text: the index's own rows are right
        groups, on = hits.select(F.col("digest").alias("key"), F.col(keep).alias("keep"), "n"), "digest"
    else:  # told apart by bytes; sha is the key here because texts with equal sha are checked below
        if not by_bytes.groupBy("sha").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").isEmpty():
            raise ValueError("two texts share a SHA-256 digest")
        best = F.min if keep == "smallest" else F.max
        groups = log.groupBy(F.col("sha").alias("key")).agg(best("row").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1")
        on = "sha"

    # A group with over 1/HOT_GROUPS of the rows is one of at most HOT_GROUPS: broadcast. The rest is spread by key.
    limit = max(1, n_rows // HOT_GROUPS)
    hot = groups.where(F.col("n") > limit).select("key", F.col("keep").alias("hot_keep"), F.col("n").alias("hot_n"))
    cold = groups.where(F.col("n") <= limit).select(F.col("key").alias("cold_key"), F.col("keep").alias("cold_keep"), F.col("n").alias("cold_n"))
    rows = log.withColumn("key", F.col(on)).join(F.broadcast(hot), "key", "left")
    # rows of hot groups get a key of their own that meets nothing, so that they don't pile up on one task
    rows = rows.withColumn("cold_key", F.when(F.col("hot_n").isNull(), F.col("key")).otherwise(F.concat(F.encode(F.lit("hot"), "UTF-8"), F.encode(F.col("row.uid").cast("string"), "UTF-8"))))
    rows = rows.join(cold, "cold_key", "left").withColumn("keep", F.coalesce("hot_keep", "cold_keep", "row"))
    return rows.select(
        F.col("row.id").cast(kind).alias(id_col),
        F.col("keep.id").cast(kind).alias("keep_id"),
        F.coalesce("hot_n", "cold_n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("keep.uid") == F.col("row.uid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one_of_each(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that exact_dedup drops; all columns stay as they are."""
    decided = durable(exact_dedup(docs, id_col, text_col, keep), "dedup-decided", compression="zstd")
    at, digest = free_names(docs.columns, "at", "digest")
    again = decided.groupBy(id_col, "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    named = lambda rows: rows.select(F.col(id_col).alias(at), F.col("text_sha256").alias(digest))
    left, stays = named(decided.where("not kept")), named(decided.where("kept"))
    same = lambda other: docs[id_col].eqNullSafe(other[at]) & (F.sha2(F.coalesce(docs[text_col], F.lit("")), 256) == other[digest])
    if again.isEmpty():
        return docs.join(left, same(left), "left_anti")
    # rows repeated with their id: of those one is kept, and which one makes no difference
    return docs.join(stays, same(stays), "left_semi").dropDuplicates([id_col, text_col])
