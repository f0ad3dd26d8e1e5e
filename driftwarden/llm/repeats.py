"""Removal of long repeated byte strings by column-wise suffix construction.

A collection of strings is built into its Burrows-Wheeler order one column at a time: each round puts one more symbol
in front of every string's suffix, re-sorts them stably by that symbol (the order so far breaks ties) and updates the
common prefixes of neighbours. A window whose common prefix with a neighbour reaches its length occurs elsewhere.

Whole texts would need as many rounds as the longest has bytes, so texts are cut where their content says so. Every
window of ``LENGTH`` bytes has an anchor, the gram of ``GRAM`` bytes in it with the least hash; equal windows have equal
anchors, so all their occurrences meet in the anchor's group, each as the string that holds every window around the
anchor. Rounds are then bounded by twice the window, groups are dealt by hash range to tasks, and shuffled blocks take
the part of the sequential files. Strings that are equal throughout are settled by their count. An anchor with very
many different strings around it would make one long group; its windows are counted one by one by hash instead, which
gives the same answer and spreads over all tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.llm.common import by_bytes, mix64, pack, pack_sorted, partitions, ranges, unpack, unpack_sorted
from driftwarden.llm.lm import power_of_two, slices
from driftwarden.runtime import cut

LENGTH = 200
GRAM = 48
REACH = LENGTH - GRAM  # how far before its anchor a window may start
WIDTH = REACH + LENGTH
BLOCK_BYTES = 1_000_000
#: Bytes of text per bucket of requests, on average, and strings that are constructed together, whole anchors at a time.
BUCKET_BYTES, RUN_STRINGS = 4_000_000, 2_048
HOT = 1024  # different strings around an anchor from which on its windows are counted one by one
_BASE = 0x9E3779B97F4A7C15
_SYMBOLS = np.random.default_rng(200).integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# what a group says about a string: it occurs again as a whole; others differ from it (few; very many)
AGAIN, OTHERS, MANY = 1, 2, 4


class Block:
    """Texts of a block with their rolling hashes, anchors and the distinct strings around these."""

    def __init__(self, raw: bytes, lengths: np.ndarray):
        self.bytes = np.frombuffer(raw, np.uint8)
        self.lengths = lengths.astype(np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        n = len(self.bytes)
        with np.errstate(over="ignore"):
            power = np.full(n + 1, _BASE, np.uint64)
            power[0] = 1
            power = np.cumprod(power, dtype=np.uint64)
            self.inverse = np.full(n + 1, pow(_BASE, -1, 2 ** 64), np.uint64)
            self.inverse[0] = 1
            self.inverse = np.cumprod(self.inverse, dtype=np.uint64)
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_SYMBOLS[self.bytes] * power[:n], dtype=np.uint64, out=self.sums[1:])
        del power
        self._anchor()

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[end] - self.sums[start]) * self.inverse[start])

    def _anchor(self) -> None:
        n = len(self.bytes)
        windows = np.maximum(self.lengths - LENGTH + 1, 0)
        is_window = np.zeros(n, bool)
        is_window[ranges(self.starts, windows)] = True
        self.at = np.zeros(0, np.int64)
        if n >= LENGTH:
            grams = np.full(n, np.iinfo(np.uint64).max, np.uint64)
            grams[:n - GRAM + 1] = self.hash(np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
            least = np.where(is_window, _slide(grams, REACH + 1, np.minimum), np.uint64(0))
            most = _slide(least[::-1], REACH + 1, np.maximum)[::-1]
            self.at = np.flatnonzero((most == grams) & (most > 0))
        doc = np.searchsorted(self.ends, self.at, side="right")
        self.low = np.maximum(self.starts[doc], self.at - REACH)  # first window, and start of the string
        self.high = np.minimum(self.at, self.ends[doc] - LENGTH)  # last window
        self.stop = np.minimum(self.at + LENGTH, self.ends[doc])
        key = self.hash(self.at, self.at + GRAM)
        with np.errstate(over="ignore"):
            shape = ((self.at - self.low) * 1000 + (self.stop - self.at)).astype(np.uint64)
            name = mix64(self.hash(self.low, self.stop) ^ mix64(shape))
        order = np.lexsort((name, key))
        key, name = key[order], name[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        self.string = np.empty(len(order), np.int64)  # number of each anchor's string
        self.string[order] = np.cumsum(new) - 1
        self.one = order[new]  # an anchor of each string
        self.key, self.name = key[new], name[new]
        self.count = np.bincount(self.string, minlength=len(self.key))

    def windows_of(self, strings: np.ndarray) -> np.ndarray:
        """Places of all windows around the anchors of the marked strings, each once."""
        mine = strings[self.string]
        step = np.zeros(len(self.bytes) + 1, np.int32)
        np.add.at(step, self.low[mine], 1)
        np.add.at(step, self.high[mine] + 1, -1)
        return np.flatnonzero(np.cumsum(step[:-1]) > 0)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i:i + width] for every i (shorter at the end), by doubling."""
    out, span = x.copy(), 1
    while span < width:
        step = min(span, width - span)
        if step >= len(out):
            break
        out[:-step] = pick(out[:-step], out[step:])
        span += step
    return out


def construct(strings: list[bytes], left: np.ndarray) -> np.ndarray:
    """For strings that hold ``left`` bytes before their anchor: (string, o) is true when the window that starts o
    bytes before the anchor has a common prefix of LENGTH bytes with another string's window at the same place.

    Column-wise: the order and the neighbours' common prefixes of all suffixes of a round come from those of the round
    before and one column of symbols.
    """
    m = len(strings)
    right = np.array([len(s) for s in strings], np.int64) - left
    table = np.zeros((WIDTH, m), np.int16)  # a row per column of the collection; 0: no symbol
    raw = np.frombuffer(b"".join(strings), np.uint8)
    sizes = left + right
    column = ranges(REACH - left, sizes)
    table[column, np.repeat(np.arange(m), sizes)] = raw.astype(np.int16) + 1
    order = np.arange(m)
    common = np.zeros(m, np.uint8)  # with the string before it in order, at most LENGTH
    found = np.zeros((m, REACH + 1), bool)
    for j in range(1, WIDTH + 1):
        symbols = table[WIDTH - j][order]
        rank = np.argsort(symbols, kind="stable")
        symbols = symbols[rank]
        same = np.zeros(m, bool)
        same[1:] = (symbols[1:] == symbols[:-1]) & (symbols[1:] > 0)
        at = np.flatnonzero(same)
        new = np.zeros(m, np.uint8)
        new[at] = np.minimum(_range_min(common, rank[at - 1] + 1, rank[at]), LENGTH - 1) + 1
        order, common = order[rank], new
        if j >= LENGTH:
            hit = common >= LENGTH
            hit[:-1] |= common[1:] >= LENGTH
            found[order[hit], j - LENGTH] = True
    return found


def _range_min(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least of x[first..last] for many ranges, from minima over powers of two."""
    if not len(first):
        return np.zeros(0, x.dtype)
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), x.dtype)
    row = x
    for k in range(int(level.max()) + 1):
        mine = np.flatnonzero(level == k)
        if len(mine):
            out[mine] = np.minimum(row[first[mine]], row[last[mine] - (1 << k) + 1])
        if len(row) > 1 << k:
            row = np.minimum(row[:-(1 << k)], row[1 << k:])
    return out


def write_blocks(docs: DataFrame) -> DataFrame:
    """block, ids, missing, lengths, text: whole texts, some MB in a row."""

    def write(frames):
        part, number = TaskContext.get().partitionId() << 32, 0
        for whole in frames:
            texts = [t.encode() if t else b"" for t in whole["text"]]
            for a, b in by_bytes([len(t) for t in texts], BLOCK_BYTES):
                ids = whole["id"].iloc[a:b]
                yield pd.DataFrame({
                    "block": [part + number], "ids": [pack(np.array([int(x) if x is not None else 0 for x in ids], np.int64))],
                    "missing": [pack(ids.isna().to_numpy().astype(np.uint8))],
                    "lengths": [pack(np.array([len(t) for t in texts[a:b]], np.int64))],
                    "text": [zstandard.ZstdCompressor(level=3).compress(b"".join(texts[a:b]))]})
                number += 1

    return docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInPandas(
        write, "block long, ids binary, missing binary, lengths binary, text binary")


def _open(row) -> Block:
    return Block(zstandard.ZstdDecompressor().decompress(row["text"]), unpack(row["lengths"], np.int64))


def _dealt(key: np.ndarray, buckets: int, number: int, /, **columns) -> pd.DataFrame:
    """A row per hash range that has keys; the columns are functions of a slice."""
    cuts = slices(key, buckets)
    at = np.flatnonzero(np.diff(cuts))
    return pd.DataFrame({"bucket": at.astype(np.int64), "block": number} | {
        name: [make(slice(cuts[k], cuts[k + 1])) for k in at] for name, make in columns.items()})


def anchor_requests(blocks: DataFrame, buckets: int) -> DataFrame:
    def ask(frames):
        for frame in frames:
            for _, row in frame.iterrows():
                b = _open(row)
                yield _dealt(b.key, buckets, row["block"], keys=lambda s: pack_sorted(b.key[s]),
                             names=lambda s: pack(b.name[s]), counts=lambda s: pack(np.minimum(b.count[s], 2).astype(np.uint8)))

    return blocks.mapInPandas(ask, "bucket int, block long, keys binary, names binary, counts binary")


def anchor_answers(requests: DataFrame, hot: int) -> DataFrame:
    """Per string: whether it occurs again, and whether others share its anchor."""

    def judge(key, frame):
        keys = [unpack_sorted(k) for k in frame["keys"]]
        sizes = np.array([len(k) for k in keys])
        keys = np.concatenate(keys)
        names = np.concatenate([unpack(x, np.uint64) for x in frame["names"]])
        counts = np.concatenate([unpack(x, np.uint8) for x in frame["counts"]])
        order = np.lexsort((names, keys))
        new_key = np.ones(len(order), bool)
        new_key[1:] = keys[order][1:] != keys[order][:-1]
        new = new_key.copy()
        new[1:] |= names[order][1:] != names[order][:-1]
        string, group = np.cumsum(new) - 1, np.cumsum(new_key) - 1
        total = np.bincount(string, counts[order])
        different = np.bincount(group[new])[group]
        flag = (total[string] > 1) * AGAIN + (different > 1) * np.where(different > hot, MANY, OTHERS)
        out = np.empty(len(order), np.uint8)
        out[order] = flag
        ends = np.cumsum(sizes)
        return pd.DataFrame({"of": frame["block"], "kind": 0, "bucket": key[0],
                             "data": [pack(out[e - n:e]) for e, n in zip(ends, sizes)]})

    return requests.groupBy("bucket").applyInPandas(judge, "of long, kind int, bucket int, data binary")


def _flags(answers: pd.DataFrame, kind: int, dtype=np.uint8) -> np.ndarray:
    mine = answers[answers["kind"] == kind].sort_values("bucket")
    return np.concatenate([unpack(d, dtype) for d in mine["data"]]) if len(mine) else np.zeros(0, dtype)


def string_requests(blocks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """kind 1: the strings of anchors that have others; kind 2: windows of anchors that have very many."""

    def ask(key, block, answer):
        columns = ["kind", "bucket", "block", "keys", "names", "sizes", "data"]
        if not len(block) or not len(answer):
            return pd.DataFrame(columns=columns)
        row = block.iloc[0]
        b, flags = _open(row), _flags(answer, 0)
        few = np.flatnonzero(flags & OTHERS)
        one = b.one[few]
        raw = b.bytes.tobytes()
        texts = [raw[x:y] for x, y in zip(b.low[one].tolist(), b.stop[one].tolist())]
        left = (b.at - b.low)[one].astype(np.uint16)
        sizes = (b.stop - b.low)[one].astype(np.uint16)
        zip_up = zstandard.ZstdCompressor(level=3).compress
        first = _dealt(b.key[few], buckets, row["block"], keys=lambda s: pack_sorted(b.key[few][s]),
                       names=lambda s: pack(b.name[few][s]),
                       sizes=lambda s: pack(np.concatenate([left[s], sizes[s]])), data=lambda s: zip_up(b"".join(texts[s])))
        places = b.windows_of((flags & MANY) > 0)
        hashes, counts = np.unique(b.hash(places, places + LENGTH), return_counts=True)
        second = _dealt(hashes, buckets, row["block"], keys=lambda s: pack_sorted(hashes[s]), names=lambda s: None,
                        sizes=lambda s: pack(np.minimum(counts[s], 2).astype(np.uint8)), data=lambda s: None)
        return pd.concat([first.assign(kind=1), second.assign(kind=2)])[columns]

    return blocks.groupBy("block").cogroup(answers.groupBy("of")).applyInPandas(
        ask, "kind int, bucket int, block long, keys binary, names binary, sizes binary, data binary")


def string_answers(requests: DataFrame) -> DataFrame:
    """kind 1: per string, the windows that another string shares; kind 2: per window, whether it occurs again."""

    def build(key, frame):
        keys = [unpack_sorted(k) for k in frame["keys"]]
        counts = np.array([len(k) for k in keys])
        ends = np.cumsum(counts)
        keys = np.concatenate(keys)
        if key[0] == 1:
            names = np.concatenate([unpack(x, np.uint64) for x in frame["names"]])
            shapes = [unpack(x, np.uint16) for x in frame["sizes"]]
            left = np.concatenate([x[:len(x) // 2] for x in shapes]).astype(np.int64)
            sizes = np.concatenate([x[len(x) // 2:] for x in shapes]).astype(np.int64)
            raw = b"".join(zstandard.ZstdDecompressor().decompress(d) for d in frame["data"])
            stops = np.cumsum(sizes)
            order = np.lexsort((names, keys))
            new = np.ones(len(order), bool)
            new[1:] = (keys[order][1:] != keys[order][:-1]) | (names[order][1:] != names[order][:-1])
            string = np.empty(len(order), np.int64)
            string[order] = np.cumsum(new) - 1
            one = order[new]
            heads = np.flatnonzero(np.r_[True, keys[one][1:] != keys[one][:-1]])  # strings of an anchor stay together
            found = []
            for a, z in by_bytes(np.diff(np.r_[heads, len(one)]).tolist(), RUN_STRINGS):
                run = one[heads[a]:heads[z] if z < len(heads) else len(one)]
                texts = [raw[e - n:e] for e, n in zip(stops[run].tolist(), sizes[run].tolist())]
                found.append(np.packbits(construct(texts, left[run]), axis=1))
            found = np.concatenate(found)[string]
            data = [pack(found[e - n:e].reshape(-1)) for e, n in zip(ends, counts)]
        else:
            times = np.concatenate([unpack(x, np.uint8) for x in frame["sizes"]])
            _, inverse = np.unique(keys, return_inverse=True)
            again = (np.bincount(inverse, times) > 1)[inverse].astype(np.uint8)
            data = [pack(again[e - n:e]) for e, n in zip(ends, counts)]
        return pd.DataFrame({"of": frame["block"], "kind": key[0], "bucket": key[1], "data": data})

    return requests.groupBy("kind", "bucket").applyInPandas(build, "of long, kind int, bucket int, data binary")


def _covered(b: Block, answer: pd.DataFrame) -> np.ndarray:
    """Bytes of the block that a repeated window covers."""
    n = len(b.bytes)
    repeated = np.zeros(n, bool)
    flags = _flags(answer, 0)
    if len(flags):
        repeated[b.windows_of((flags & AGAIN) > 0)] = True
        few = np.flatnonzero(flags & OTHERS)
        if len(few):
            bits = _flags(answer, 1).reshape(len(few), -1)
            found = np.unpackbits(bits, axis=1, count=REACH + 1).astype(bool)
            number = np.full(len(flags), -1)
            number[few] = np.arange(len(few))
            mine = np.flatnonzero(number[b.string] >= 0)
            for i in range(0, len(mine), 100_000):
                part = mine[i:i + 100_000]
                at, before = np.nonzero(found[number[b.string[part]]])
                repeated[b.at[part][at] - before] = True
        many = (flags & MANY) > 0
        if many.any():
            places = b.windows_of(many)
            hashes, inverse = np.unique(b.hash(places, places + LENGTH), return_inverse=True)
            again = _flags(answer, 2).astype(bool)
            repeated[places[again[inverse]]] = True
    step = np.zeros(n + LENGTH + 1, np.int32)
    at = np.flatnonzero(repeated)
    step[at] += 1
    step[at + LENGTH] -= 1
    return np.cumsum(step)[:n] > 0


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    A byte goes when a string of LENGTH bytes that covers it starts anywhere else too, in the same text or another.
    Null texts are empty; texts shorter than LENGTH keep all bytes. Repeated rows are texts of their own, so long
    ones go entirely. Null ids stay null. An empty table gives no rows. ``hot`` changes the plan, not the result.
    """
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = power_of_two(max(4 * partitions(docs.sparkSession), -(-held // BUCKET_BYTES)))
    blocks = cut(write_blocks(docs), "repeat-blocks")
    first = cut(anchor_answers(anchor_requests(blocks, buckets), hot), "repeat-anchors")
    asked = cut(string_requests(blocks, first, buckets), "repeat-strings")
    answers = first.unionByName(string_answers(asked))

    def finish(key, block, answer):
        columns = {"doc_id": pd.array([], "Int64"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        if not len(block):
            return pd.DataFrame(columns)
        row = block.iloc[0]
        b = _open(row)
        gone = _covered(b, answer)
        ids = pd.array(unpack(row["ids"], np.int64), "Int64")
        ids[unpack(row["missing"], np.uint8).astype(bool)] = pd.NA
        out = []
        for start, end in zip(b.starts, b.ends):
            mine = gone[start:end]
            spans = int(np.count_nonzero(np.diff(mine.astype(np.int8), prepend=0) == 1))
            kept = b.bytes[start:end][~mine].tobytes()
            out.append((end - start, int(mine.sum()), spans, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(out, columns=list(columns)[1:]).assign(doc_id=ids)[list(columns)]

    return blocks.groupBy("block").cogroup(answers.groupBy("of")).applyInPandas(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
