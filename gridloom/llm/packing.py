"""Packing documents into sequences of a fixed number of tokens, by the sum-of-squares rule."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, free_names, ship_package, tidied

#: Pieces that one task packs: bounds its memory, and leaves at most a few partly filled sequences for each.
PIECES_PER_GROUP = 1 << 17
#: How often the pieces of bins that stayed open are dealt again, at most.
DEALS = 16


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, by the sum-of-squares rule in the order given.

    With n[g] open bins of residual gap g, a piece of length s goes where the sum of n[g]**2 over all gaps becomes
    smallest: into a bin of gap g >= s (g becomes g - s) or into a new bin. Full bins (gap 0) don't count. Of equal
    places the smallest gap is taken, a new bin last.
    """
    n = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    far = np.iinfo(np.int64).max // 4
    for i, s in enumerate(lengths.tolist()):
        g, new = capacity, 0
        if s < capacity:
            new = n[capacity - s]  # half of the change, less 1/2, when a new bin is opened
            gap = n[s:capacity]
            change = np.where(gap > 0, n[: capacity - s] - gap + 1, far)  # half of it, less 1/2 where the bin fills up
            change[0] = -gap[0] if gap[0] > 0 else far
            best = int(change.argmin())
            if change[best] <= new:
                g = s + best
        if g == capacity:
            b, made = made, made + 1
        else:
            b = open_bins[g].pop()
            n[g] -= 1
        bins[i], offsets[i] = b, capacity - g
        if g > s:
            n[g - s] += 1
            open_bins[g - s].append(b)
    return bins, offsets


def place_all(lengths: np.ndarray, capacity: int, deals: int = DEALS) -> tuple[np.ndarray, np.ndarray]:
    """place() from the longest piece to the shortest; then the pieces of bins that stayed open are dealt again and again.

    Each further deal is place() over those pieces alone, longest first but for up to a sixteenth of the capacity, which a
    seeded generator adds to each length; it counts where it needs no more bins. So every piece is placed by the
    sum-of-squares rule, and equal input gives equal output.
    """
    order, rng = np.argsort(-lengths, kind="stable"), np.random.default_rng(0)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bins[order], offsets[order] = place(lengths[order], capacity)
    for _ in range(deals if len(lengths) else 0):
        fill = np.bincount(bins, weights=lengths)
        left_open = fill < capacity
        if left_open.sum() <= -(-int(fill[left_open].sum()) // capacity):  # no deal can need fewer
            break
        again = np.flatnonzero(left_open[bins])
        again = again[np.argsort(-(lengths[again] + rng.integers(0, max(1, capacity // 16), len(again))), kind="stable")]
        other, at = place(lengths[again], capacity)
        if other.max() + 1 <= left_open.sum():
            bins[again], offsets[again] = other + len(fill), at
            bins = np.unique(bins, return_inverse=True)[1]
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """The documents' pieces: id, piece, start, length, ids_crc32, and with_ids their ids (little-endian 32-bit).

    A document's ids are those of its text (null: none) and end_id. Only documents over capacity are cut, into pieces of
    capacity tokens; the first takes what is left over.
    """
    ship_package(docs.sparkSession)

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from gridloom.llm.tokenize import crc32_of, encoder

        tok = encoder(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for i in range(0, batch.num_rows, 2000):
                rows, raws = [], tok.encode(texts[i : i + 2000])
                for key, raw in zip(keys[i : i + 2000].to_pylist(), raws, strict=True):
                    ids = np.append(tok.ids(raw), tok.dtype.type(end_id))
                    first = len(ids) % capacity or capacity
                    for k, start in enumerate(range(first - capacity, len(ids), capacity)):
                        part = ids[max(start, 0) : start + capacity]
                        rows.append((key, k, max(start, 0), len(part), crc32_of(part), part.astype("<u4").tobytes() if with_ids else None))
                columns = list(zip(*rows, strict=True))
                kinds = [keys.type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)][: 6 if with_ids else 5]
                yield pa.record_batch(made, names=["key", "piece", "start", "length", "ids_crc32", "ids"][: len(made)])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(tidied(cut), schema).withColumnRenamed("key", id_col)


def pack(lengths: DataFrame, capacity: int = 1024, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """lengths (any columns, with a long 'length' from 1 to capacity) with sequence_id and offset added.

    Rows are numbered as they are written to the shared folder and dealt by a hash of their number to groups of about
    per_group rows, so equal rows spread like others; each group is packed by itself, which bounds its memory, and can be
    made again if its executor is lost. Rows that are alike in every column may change places. Offsets are gapless from 0
    in each sequence. Sequence ids are any distinct numbers. No rows give no rows.
    """
    columns = [c for c in lengths.columns if c not in ("sequence_id", "offset")]
    uid, group = free_names(columns, "uid", "group")
    lengths = durable(lengths.select(*columns, F.monotonically_increasing_id().alias(uid)), "packing-pieces", compression="zstd")
    groups = -(-lengths.count() // per_group) or 1
    ship_package(lengths.sparkSession)

    def deal(pdf):
        from gridloom.llm.packing import place_all

        own = int(pdf[group].iloc[0])
        pdf = pdf.sort_values(["length", uid], ascending=[False, True]).drop(columns=[uid, group]).reset_index(drop=True)
        bins, offsets = place_all(pdf["length"].to_numpy(), capacity)
        return pdf.assign(sequence_id=(own << 40) + bins, offset=offsets)

    schema = lengths.select(*columns).schema.add("sequence_id", "long").add("offset", "long")
    return lengths.withColumn(group, F.pmod(F.xxhash64(uid), F.lit(groups))).groupBy(group).applyInPandas(deal, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece of one token (the end). Repeated rows are packed each by itself. An empty table
    gives no rows; columns other than id and text play no part.
    """
    return pack(pieces(docs, tokenizer, id_col, text_col, end_id, capacity), capacity)


def sequences(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """The packed sequences themselves: sequence_id, input_ids (array of int, in order of offset), segments."""
    with_ids = pack(pieces(docs, tokenizer, id_col, text_col, end_id, capacity, with_ids=True), capacity)
    rows = with_ids.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", id_col, "piece", "ids"))).alias("parts"))  # at most capacity parts

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            whole = [np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").astype(np.int32) for parts in batch.column(1).to_pylist()]
            lists = pa.array(whole, pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), lists, pa.array([len(p) for p in batch.column(1).to_pylist()], pa.int32())], names=["sequence_id", "input_ids", "segments"])

    return rows.mapInArrow(join, "sequence_id long, input_ids array<int>, segments int")
