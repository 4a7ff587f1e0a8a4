"""Token ids of whole texts by a tokenizers file, with a bounded memo of words for byte-level models."""

from __future__ import annotations

import json
import zlib

import numpy as np

from .common import Batch, mix, span_hashes

#: Words that one worker remembers; when a chunk of texts begins with more, all are forgotten. Only speed depends on it.
MEMO_WORDS = 400_000
#: Bytes of text that are looked up together, and words that the tokenizer gets in one string.
CHUNK_BYTES, WORDS_AT_ONCE = 1 << 20, 500
#: Lead bytes of white space beyond ASCII in UTF-8, and what may follow each (fixed values of Unicode; U+180E was one).
WIDE_SPACE = {0xC2: (b"\x85", b"\xa0"), 0xE1: (b"\x9a\x80", b"\xa0\x8e"), 0xE2: (*(bytes([0x80, x]) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), b"\x81\x9f"), 0xE3: (b"\x80\x80",)}
_open: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One a worker process and file."""
    if path not in _open:
        _open[path] = Encoder(path)
    return _open[path]


class Memo:
    """Words by 128 bits of their hash, in numpy arrays: where the ids of each begin, and how many there are."""

    def __init__(self, dtype: np.dtype) -> None:
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.n = self.n_ids = 0
        self.keys, self.at, self.count = np.zeros((1 << 12, 2), np.uint64), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.ids, self.slots = np.zeros(1 << 13, self.dtype), np.full(1 << 13, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where it is not held."""
        mask, out = len(self.slots) - 1, np.full(len(keys), -1, np.int32)
        slot, left = (keys[:, 0] & np.uint64(mask)).astype(np.int64), np.arange(len(keys))
        while len(left):
            place = self.slots[slot]
            held = place >= 0
            slot, left, place = slot[held], left[held], place[held]
            same = (self.keys[place, 0] == keys[left, 0]) & (self.keys[place, 1] == keys[left, 1])
            out[left[same]] = place[same]
            slot, left = (slot[~same] + 1) & mask, left[~same]
        return out

    def _put(self, places: np.ndarray) -> None:
        mask = len(self.slots) - 1
        slot = (self.keys[places, 0] & np.uint64(mask)).astype(np.int64)
        while len(places):
            free = np.flatnonzero(self.slots[slot] < 0)
            self.slots[slot[free]] = places[free]  # of several that want a slot the last one has it
            left = self.slots[slot] != places
            slot, places = (slot[left] + 1) & mask, places[left]

    def add(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """New, distinct keys; ids: those of all words one after another, count of each."""
        n, m = self.n + len(keys), self.n_ids + len(ids)
        if n > len(self.keys):
            more = max(n, 2 * len(self.keys)) - len(self.keys)
            self.keys = np.concatenate([self.keys, np.zeros((more, 2), np.uint64)])
            self.at, self.count = np.append(self.at, np.zeros(more, np.int64)), np.append(self.count, np.zeros(more, np.int32))
        if m > len(self.ids):
            self.ids = np.append(self.ids, np.zeros(max(m, 2 * len(self.ids)) - len(self.ids), self.dtype))
        self.keys[self.n : n], self.count[self.n : n], self.ids[self.n_ids : m] = keys, count, ids
        self.at[self.n : n] = self.n_ids + np.cumsum(count) - count
        new, self.n, self.n_ids = np.arange(self.n, n, dtype=np.int32), n, m
        if 2 * n > len(self.slots):
            self.slots = np.full(1 << (4 * n - 1).bit_length(), -1, np.int32)
            new = np.arange(n, dtype=np.int32)
        self._put(new)


class Encoder:
    """encode(texts) gives each text's ids (no special tokens added) as the bytes of little-endian integers of dtype.

    A byte-level model cuts a text at each single space or line break between other characters before it merges, so the
    ids of such a text are those of its words one after another; words are encoded once and remembered. Texts with any
    other white space or control characters, or with a special token's string, go to the tokenizer whole. Both ways give
    the same ids. Nothing is forgotten while a chunk of texts is encoded, so a text may have any number of words.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True) and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocab.values()) + 1
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.begins = np.zeros(size, bool)
        self.begins[[i for t, i in vocab.items() if t[:1] in ("Ġ", "Ċ")]] = True  # a byte-level space, line break
        self.memo = Memo(self.dtype)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        """words: each with the space or line break before it."""
        ids, counts = [], []
        for i in range(0, len(words), WORDS_AT_ONCE):
            some = words[i : i + WORDS_AT_ONCE]
            own = np.array(self.tokenizer.encode_batch_fast([b"".join(some).decode()], add_special_tokens=False)[0].ids, self.dtype)
            at = np.flatnonzero(self.begins[own])
            if len(at) == len(some) and at[0] == 0:
                counts.append(np.diff(at, append=len(own)))
            else:
                found = self._whole([w.decode() for w in some])
                own = np.frombuffer(b"".join(found), self.dtype)
                counts.append(np.array([len(x) // self.dtype.itemsize for x in found]))
            ids.append(own)
        self.memo.add(keys, np.concatenate(ids), np.concatenate(counts).astype(np.int32))

    def _regular(self, batch: Batch, space: np.ndarray) -> np.ndarray:
        """Which texts have single spaces and line breaks between words, and no other white space or special string."""
        data, at, n = batch.data, batch.at, batch.n
        odd = (data < 32) & (data != 10)
        odd[1:] |= space[1:] & space[:-1]
        full = np.flatnonzero(at[1:] > at[:-1])
        odd[at[full]] |= space[at[full]]
        odd[at[full + 1] - 1] |= space[at[full + 1] - 1]
        for lead, after in WIDE_SPACE.items():
            for place in np.flatnonzero(data == lead).tolist():
                if data[place + 1 : place + 3].tobytes().startswith(after):
                    odd[place] = True
        out = np.ones(n, bool)
        out[np.searchsorted(at, np.flatnonzero(odd), "right") - 1] = False
        raw = None
        for s in self.special:
            raw = data.tobytes() if raw is None else raw
            place = raw.find(s)
            while place >= 0:
                out[np.searchsorted(at, place, "right") - 1] = False
                place = raw.find(s, place + 1)
        return out

    def _chunk(self, batch: Batch) -> list[bytes]:
        data, at, n, size = batch.data, batch.at, batch.n, self.dtype.itemsize
        if not len(data):
            return [b""] * n
        space = (data == 32) | (data == 10)
        regular = self._regular(batch, space) if self.by_word else np.zeros(n, bool)
        solid = ~space & np.repeat(regular, np.diff(at))
        firsts = at[:-1][at[1:] > at[:-1]]
        step = solid.copy()
        step[1:] &= space[:-1]
        step[firsts] = solid[firsts]
        begin = np.flatnonzero(step)
        step[:-1] = solid[:-1] & space[1:]
        step[-1] = solid[-1]
        step[at[1:][at[1:] > at[:-1]] - 1] = solid[at[1:][at[1:] > at[:-1]] - 1]
        end = np.flatnonzero(step) + 1
        first = np.zeros(len(data), bool)
        first[firsts] = True
        first = first[begin]
        line = first | (data[np.maximum(begin - 1, 0)] == 10)
        keys = np.stack([span_hashes(data, begin, end, k) for k in (0, 1)], axis=1)
        keys[:, 0] = mix(keys[:, 0] + line.astype(np.uint64))
        found = self.memo.find(keys)
        new = np.flatnonzero(found < 0)
        if len(new):
            if self.memo.n > MEMO_WORDS:
                self.memo.clear()
                new = np.arange(len(keys))
            missing, raw = new, data.tobytes()
            while len(missing):  # more than once only if two words share half of their keys
                some = missing[np.unique(keys[missing, 0], return_index=True)[1]]
                words = [b"\n" + raw[b:e] if f else raw[b - 1 : e] for b, e, f in zip(begin[some].tolist(), end[some].tolist(), first[some].tolist(), strict=True)]
                self._learn(keys[some], words)
                found[new] = self.memo.find(keys[new])
                missing = new[found[new] < 0]
        start, count = self.memo.at[found] + first, self.memo.count[found] - first
        ids_at = np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        flat = self.memo.ids[np.arange(ids_at[-1]) + np.repeat(start - ids_at[:-1], count)].tobytes()
        cut = (ids_at[np.searchsorted(begin, at)] * size).tolist()
        out = [flat[a:b] for a, b in zip(cut, cut[1:], strict=False)]
        whole = np.flatnonzero(~regular & (np.diff(at) > 0)).tolist()
        for i, x in zip(whole, self._whole([data[at[i] : at[i + 1]].tobytes().decode() for i in whole]), strict=True):
            out[i] = x
        return out

    def encode(self, texts) -> list[bytes]:
        """texts: an Arrow array, or a list of str or None."""
        import pyarrow as pa

        batch = Batch(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
        return [x for _, part in batch.parts(CHUNK_BYTES) for x in self._chunk(part)]

    def ids(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.dtype)


def crc32_of(ids: np.ndarray) -> int:
    """Of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
