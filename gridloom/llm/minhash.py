"""Near-duplicate groups: fast similarity sketching, banding, and verification on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, Batch, durable, free_names, may_contain, membership_filter, mix, ship_package, split_by_filter, tidied, window_hashes, words_of
from .components import components

#: A link at similarity 0.8 is missed by all bands with probability (1 - 0.8**ROWS)**BANDS = 8e-6.
BANDS, ROWS = 64, 8
COORDINATES = BANDS * ROWS
#: 8 bits of each coordinate are kept, for buckets and to estimate the similarity of two documents; and by how many standard
#: deviations the equal ones may fall short of their expected number at the threshold before two are no longer compared.
MARKS, DEVIATIONS = COORDINATES, 5
#: Documents, and shingles of theirs, of one block; a task holds the documents of two blocks at most.
BLOCK, BLOCK_SHINGLES = 2000, 1 << 21
#: Up to so many blocks the documents of a group meet pair of blocks by pair of blocks; beyond, bucket by bucket. Either way
#: those and only those pairs are compared that share a bucket, so results don't depend on it.
WHOLE_BLOCKS = 16
#: Shingles that one task is given to compare, about.
TASK_SHINGLES = 1 << 20
_EMPTY = np.uint64((1 << 64) - 1)


def shingle_sets(batch: Batch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash) of all distinct shingles, by document and hash, and a 128-bit digest of each word sequence."""
    _, _, doc, h = words_of(batch, lower=True)
    words = np.bincount(doc, minlength=batch.n)
    _, sdoc, sh = window_hashes(h, doc, width)
    first = np.concatenate([[0], np.cumsum(words)[:-1]]).astype(np.int64)
    docs, hashes = [sdoc], [sh]
    for n in range(1, width):  # the whole sequence as one
        own = np.flatnonzero(words == n)
        x = np.full(len(own), np.uint64(n) << np.uint64(56), np.uint64)
        for i in range(n):
            x = mix(x * np.uint64(0xFF51AFD7ED558CCD) + h[first[own] + i] + np.uint64(i + 1))
        docs.append(own)
        hashes.append(x)
    sdoc, sh = np.concatenate(docs), np.concatenate(hashes)
    o = np.argsort(sh)
    narrow = sdoc[o].astype(np.uint16) if batch.n < 1 << 16 else sdoc[o]
    o = o[np.argsort(narrow, kind="stable")]
    sdoc, sh = sdoc[o], sh[o]
    new = np.ones(len(sh), bool)
    new[1:] = (sh[1:] != sh[:-1]) | (sdoc[1:] != sdoc[:-1])
    place = (np.arange(len(h)) - first[doc]).astype(np.uint64)
    digest = np.zeros((batch.n, 2), np.uint64)
    for j, k in enumerate((0x9FB21C651E98DF25, 0xC13FA9A902A6328F)):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(mix(h ^ mix(place * np.uint64(k) + np.uint64(k))), out=total[1:])
        digest[:, j] = total[first + words] - total[first]
    return sdoc[new], sh[new], digest


def sketches(sdoc: np.ndarray, sh: np.ndarray, n_docs: int, t: int = COORDINATES) -> np.ndarray:
    """The fast similarity sketch of each document, t coordinates; documents without shingles keep empty ones.

    In round i < t each element goes into a bin that round's hash names; in rounds t to 2t - 1 each goes into bin i - t,
    so that every bin fills. A bin keeps the smallest value of the first round that reached it. A document takes part
    until its bins are full.
    """
    out = np.full((n_docs, t), _EMPTY, np.uint64)
    flat = out.reshape(-1)
    counts = np.bincount(sdoc, minlength=n_docs)
    active = np.flatnonzero(counts)
    doc, h = sdoc, sh
    low = np.uint64((1 << 53) - 1)
    for i in range(2 * t):
        if not len(active):
            break
        x = mix(h + np.uint64(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        b = (x >> np.uint64(54)).astype(np.int64) % t if i < t else i - t
        np.minimum.at(flat, doc * t + b, np.uint64(i << 53) | (x & low))
        left = (out[active] == _EMPTY).any(axis=1)
        if not left.all():
            active = active[left]
            stays = np.zeros(n_docs, bool)
            stays[active] = True
            keep = stays[doc]
            doc, h = doc[keep], h[keep]
    return out


def marks_of(sketch: np.ndarray) -> np.ndarray:
    """8 bits of each coordinate, which both buckets and estimates are made from."""
    return (sketch & np.uint64(255)).astype(np.uint8)


def band_keys(marks: np.ndarray) -> np.ndarray:
    """A key for each band of each document: that of its ROWS marks, so equal marks and equal keys are one thing."""
    words = np.ascontiguousarray(marks).view("<u8").astype(np.uint64)
    return mix(words ^ mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def sketch_table(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, n_shingles, words (digest of the word sequence, null without words), bands, marks) for each row."""
    ship_package(docs.sparkSession)

    def sketch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import minhash as M
        from gridloom.llm.common import Batch

        for batch in batches:
            for i, part in Batch(batch.column(1)).parts():
                sdoc, sh, digest = M.shingle_sets(part, width)
                n = np.bincount(sdoc, minlength=part.n)
                s = M.sketches(sdoc, sh, part.n)
                marks, some = M.marks_of(s), n > 0
                keys = M.band_keys(marks).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.n + 1, dtype=np.int32) * M.BANDS), pa.array(keys.reshape(-1)))
                yield pa.record_batch(
                    [batch.column(0).slice(i, part.n), pa.array(n, pa.int64()), pa.array([d.tobytes() if k else None for d, k in zip(digest, some, strict=True)], pa.binary()), lists, pa.array([m.tobytes() if k else None for m, k in zip(marks, some, strict=True)], pa.binary())],
                    names=["id", "n_shingles", "words", "bands", "marks"],
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidied(sketch), "id long, n_shingles long, words binary, bands array<long>, marks binary")


def shingle_table(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, words, shingles) of each row: the digest of its words, and its shingles' hashes, ascending, as bytes."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import minhash as M
        from gridloom.llm.common import Batch

        for batch in batches:
            for i, part in Batch(batch.column(1)).parts():
                sdoc, sh, digest = M.shingle_sets(part, width)
                cut = np.searchsorted(sdoc, np.arange(part.n + 1))
                yield pa.record_batch(
                    [batch.column(0).slice(i, part.n), pa.array([d.tobytes() for d in digest], pa.binary()), pa.array([sh[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())],
                    names=["id", "words", "shingles"],
                )

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidied(run), "id long, words binary, shingles binary")


def links_of_run(ids: np.ndarray, comp: np.ndarray, n: np.ndarray, role: np.ndarray, marks: np.ndarray, shingles: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the documents of a run, as few as join all components that any link joins.

    role: 0 for a document that is compared with those of role 1 and 2, 1 for one that others are compared with, 2 for
    both. Pairs that share no bucket are passed over, whatever the size of the run's group; so are those inside one
    component, also by links found before, and those whose sizes or marks rule a link out; every other pair's full sets
    are compared.
    """
    p = percent / 100
    least = int(MARKS * p - DEVIATIONS * (MARKS * p * (1 - p)) ** 0.5)
    label, right, out = np.unique(comp, return_inverse=True)[1], np.flatnonzero(role != 0), []
    for a in np.flatnonzero(role != 1).tolist():
        b = right[label[right] != label[a]]
        if role[a] == 2:
            b = b[(role[b] != 2) | (b > a)]
        b = b[100 * np.minimum(n[b], n[a]) >= percent * np.maximum(n[b], n[a])]
        if not len(b):
            continue
        same = marks[b] == marks[a]
        b = b[(same.sum(axis=1) >= least) & same.reshape(len(b), BANDS, ROWS).all(axis=2).any(axis=1)]
        own = shingles[a]
        while len(b):
            some = b[: max(1, int(np.searchsorted(np.cumsum(n[b]), 1 << 20)))]
            h = np.concatenate([shingles[x] for x in some.tolist()])
            hit = own[np.minimum(np.searchsorted(own, h), len(own) - 1)] == h
            same = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(n[some])[:-1]]))
            for x in some[100 * same >= percent * (n[a] + n[some] - same)].tolist():
                if label[x] != label[a]:
                    out.append((int(ids[a]), int(ids[x])))
                    label[label == label[x]] = label[a]
            b = b[len(some) :]
            b = b[label[b] != label[a]]
    return out


def compare(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) inside each run of rows (key, i, j, role, id, n, comp); sets: (id, size, marks, shingles).

    A run's documents meet in one task, which confirms links on their full sets and gives no more of them than the run
    has documents.
    """
    ship_package(rows.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm import minhash as M

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= M.BLOCK:
                left, out = M.compare_runs(pa.Table.from_batches(held).combine_chunks(), percent, last=False)
                held, size = left.to_batches(), left.num_rows
                yield out
        if held:
            yield M.compare_runs(pa.Table.from_batches(held).combine_chunks(), percent, last=True)[1]

    tasks = max(12, int(rows.agg(F.sum("n")).first()[0] or 0) // TASK_SHINGLES)
    work = rows.join(sets, "id").select("key", "i", "j", "role", "id", "comp", "size", "marks", "shingles").repartition(tasks, "key", "i", "j")
    return durable(work.sortWithinPartitions("key", "i", "j", "id").mapInArrow(run, "a long, b long"), "links", compression="zstd")


def compare_runs(table, percent: int, last: bool):
    """links_of_run for each run of equal (key, i, j): (rows of a run that may go on, links found)."""
    import pyarrow as pa

    key, i, j, role, ids, comp, n = (table.column(c).to_numpy() for c in ("key", "i", "j", "role", "id", "comp", "size"))
    step = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    edges, found = [0, *step.tolist(), len(key)], []
    whole = edges if last else edges[:-1]
    for s, e in zip(whole, whole[1:], strict=False):
        if e - s > 1:
            marks = np.frombuffer(b"".join(table.column("marks").slice(s, e - s).to_pylist()), np.uint8).reshape(e - s, MARKS)
            shingles = [np.frombuffer(x, np.uint64) for x in table.column("shingles").slice(s, e - s).to_pylist()]
            found += links_of_run(ids[s:e], comp[s:e], n[s:e], role[s:e], marks, shingles, percent)
    a, b = (np.array([x[k] for x in found], np.int64) for k in (0, 1))
    return table.slice(len(key) if last else whole[-1]), pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _bytes(c: Column | str) -> Column:
    """A number as a key that attach() takes."""
    return F.encode((F.col(c) if isinstance(c, str) else c).cast("string"), "UTF-8")


def _parts(size: str, shingles: str) -> Column:
    """Into how many blocks so many documents with so many shingles are dealt."""
    return F.greatest(F.lit(1), F.ceil(F.col(size) / BLOCK), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("int")


def _own(parts: str) -> Column:
    """The block that a document is dealt to."""
    return F.pmod(F.xxhash64("id", F.lit(7)), F.col(parts)).cast("int")


def _links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join all documents which any links between documents of equal buckets join; members: (key, id, n, lead).

    Documents that buckets connect, directly or over others, form a group. In a group of up to WHOLE_BLOCKS blocks those
    that share a bucket are compared, each pair of blocks in one run. In a larger one each document is first compared with the
    smallest ids of its buckets, block by block. Then buckets that still lie in several components are compared: the
    documents outside of the lead's component, in blocks, with all documents of the bucket, in blocks. Of buckets with the
    same documents one is taken.
    """
    groups = components(members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")))
    size = members.select("id", "n").distinct().join(groups, "id")
    size = durable(size.select("id", "n", "component", _bytes("component").alias("at")), "near-groups", compression="zstd")
    sums = size.groupBy("at").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("mass"))
    size = durable(attach(size, sums, "at", "docs", size.count(), "id").withColumn("parts", _parts("docs", "mass")), "near-group-sizes", compression="zstd")
    whole = size.where(F.col("parts") <= WHOLE_BLOCKS).withColumn("own", _own("parts")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    role = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    small = compare(whole.select(F.col("component").alias("key"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), role.alias("role"), "id", "n", F.col("id").alias("comp")), sets, percent)
    large = size.where(F.col("parts") > WHOLE_BLOCKS).select("id")
    if large.isEmpty():
        return small

    rows = members.join(large, "id")
    buckets = rows.groupBy("key", "lead").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("mass"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    buckets = durable(buckets.groupBy("lead", "docs", "mass", "x", "y").agg(F.min("key").alias("key")).select(_bytes("key").alias("at"), "docs", "mass", _parts("docs", "mass").alias("parts")), "near-buckets", compression="zstd")
    rows = rows.withColumn("at", _bytes("key"))
    rows = durable(attach(rows, buckets, "at", "docs", rows.count(), "id").where("docs is not null"), "near-large", compression="zstd")
    own = rows.where("id <> lead").groupBy("lead", "id").agg(F.min(F.struct("key", "parts", "n")).alias("k")).select(F.col("k.key").alias("key"), F.lit(0).alias("i"), F.pmod(F.xxhash64("id", F.lit(7)), F.col("k.parts")).cast("int").alias("j"), "id", "lead", F.col("k.n").alias("n"))
    own = durable(own, "near-lead-rows", compression="zstd")
    leads = own.select("key", "i", "j", F.lit(0).alias("role"), F.col("lead").alias("id"), F.lit(1).cast("long").alias("n")).distinct()  # n only weighs tasks here; sets have a lead's own
    first = compare(own.select("key", "i", "j", F.lit(1).alias("role"), "id", "n").unionByName(leads).withColumn("comp", F.col("id")), sets, percent)

    found = components(first)
    by_id = found.select(_bytes("id").alias("at"), "component", F.lit(1).alias("docs"))
    leads = durable(rows.select("lead").distinct().join(found.withColumnRenamed("id", "lead"), "lead", "left").select("lead", F.coalesce("component", "lead").alias("major")), "near-leads", compression="zstd")
    rows = rows.drop("at", "docs", "mass").join(found, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    weights = rows.groupBy(_bytes("lead").alias("at")).agg(F.count(F.lit(1)).alias("docs"))
    major = leads.select(_bytes("lead").alias("at"), "major").join(weights, "at")
    rows = durable(attach(rows.withColumn("at", _bytes("lead")), major, "at", "docs", rows.count(), "id").withColumn("minor", F.col("comp") != F.col("major")), "near-open", compression="zstd")
    sums = rows.groupBy(_bytes("key").alias("at")).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("mass"), F.count_if("minor").alias("others"), F.sum(F.when(F.col("minor"), F.col("n"))).alias("other_mass")).where("others > 0")
    sums = durable(sums.select("at", "docs", _parts("docs", "mass").alias("columns"), _parts("others", "other_mass").alias("lines")), "near-open-buckets", compression="zstd")
    if sums.isEmpty():
        return small.unionByName(first)
    rows = attach(rows.drop("docs", "parts").withColumn("at", _bytes("key")), sums, "at", "docs", rows.count(), "id").where("docs is not null")
    rows = durable(rows.withColumn("line", _own("lines")).withColumn("column", _own("columns")), "near-open-rows", compression="zstd")
    lines = rows.where("minor").withColumn("j", F.explode(F.sequence(F.lit(0), F.col("columns") - 1))).select("key", F.col("line").alias("i"), "j", F.when(F.col("j") == F.col("column"), 2).otherwise(0).alias("role"), "id", "n", "comp")
    others = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("lines") - 1))).where("not (minor and i = line)").select("key", "i", F.col("column").alias("j"), F.lit(1).alias("role"), "id", "n", "comp")
    return small.unionByName(first).unionByName(compare(lines.unionByName(others), sets, percent))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable over links), kept (id = component_id).

    A document's set is its distinct runs of width words (A-Z lower-cased); with fewer words the whole sequence is one
    run; without words, or with a null text, the set is empty and the document has no link. Two documents are linked if
    100 * intersection >= percent * union. Rows that share an id count as linked; a row with a null id has no link, a
    null component and is kept. An empty table gives no rows; other columns play no part.

    Documents with the same words are first folded into one. Sketches are cut into BANDS keys; documents with an equal
    key meet in a bucket, and every two documents of a bucket are compared unless links join them already. Every link is
    confirmed on full sets where the documents meet (see _links), so no bucket is capped and pairs are never listed.
    """
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    table = durable(sketch_table(docs, id_col, text_col, width), "sketches", compression="zstd")
    n_rows = table.count()
    rows = table.select("id", "n_shingles", F.coalesce("words", F.encode(F.concat(F.lit("empty"), F.col("id").cast("string")), "UTF-8")).alias("words")).where("id is not null")
    groups = durable(rows.groupBy("words").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1"), "folds", compression="zstd")
    folded = durable(attach(rows, groups, "words", "copies", n_rows, "id").select("id", "n_shingles", F.coalesce("rep", "id").alias("rep")), "folded", compression="zstd")

    # one row for each sequence of words; a filter finds the few rows that have copies
    some, others = split_by_filter(table.where("words is not null and id is not null").withColumn("key", F.xxhash64("words")), "key", membership_filter(groups.select(F.xxhash64("words").alias("key")), "key", groups.count()))
    one = some.groupBy("words").agg(F.min("id").alias("id"), F.first(F.struct("n_shingles", "bands", "marks")).alias("own")).select("id", "words", "own.*")
    reps = others.drop("key").unionByName(durable(one, "near-folded-sketches", compression="zstd"))
    keys = reps.select("id", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    buckets = durable(keys.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("_last")).where("lead < _last").select("key", "lead"), "buckets", compression="zstd")
    members = durable(may_contain(keys, "key", membership_filter(buckets, "key", buckets.count())).join(buckets, "key"), "bucket-members", compression="zstd")

    met = durable(members.select("id").distinct().withColumn("key", F.xxhash64("id")), "near-met", compression="zstd")
    words = membership_filter(met, "key", met.count())
    marks = may_contain(reps.select("id", "words", F.col("n_shingles").alias("size"), "marks").withColumn("key", F.xxhash64("id")), "key", words).drop("key")
    texts = may_contain(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("id")), "key", words)
    shingles = shingle_table(texts, "id", "text", width)
    twice = not folded.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if twice:  # rows repeated with their id
        shingles = shingles.groupBy("id", "words").agg(F.first("shingles").alias("shingles"))
    sets = durable(shingles.join(marks, ["id", "words"]).drop("words"), "near-sets", compression="zstd")
    found = components(_links(members, sets, percent))

    # a copy's component is that of the row it was folded into; hot groups are joined by broadcast again
    by_rep = folded.groupBy("rep").agg(F.count(F.lit(1)).alias("copies"))
    comp = found.join(by_rep.withColumnRenamed("rep", "id"), "id").select(_bytes("id").alias("at"), "component", "copies")
    out = attach(folded.withColumn("at", _bytes("rep")), comp, "at", "copies", n_rows, "id")
    out = out.select("id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    if twice:  # rows that share an id but not their words belong together
        joined = components(out.select(F.col("id").alias("a"), F.col("component_id").alias("b")).distinct())
        out = out.join(joined, "id", "left").select("id", "n_shingles", F.coalesce("component", "component_id").alias("component_id"))
    out = out.unionByName(table.where("id is null").select("id", "n_shingles", F.lit(None).cast("long").alias("component_id")))
    return out.select(F.col("id").cast(kind).alias(id_col), "n_shingles", F.col("component_id").cast(kind).alias("component_id"), F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one_of_each(docs: DataFrame, width: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows of documents that are not the smallest id of their group; all columns stay."""
    (gone,) = free_names(docs.columns, "gone")
    drop = durable(near_duplicates(docs, id_col, text_col, width), "near-decided", compression="zstd").where("not kept").select(F.col(id_col).alias(gone)).distinct()
    return docs.join(drop, docs[id_col] == drop[gone], "left_anti")
