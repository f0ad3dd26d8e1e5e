"""Language-model scoring with a weighted backoff automaton.

Smoothed n-grams of up to three words form an automaton. Its states are the histories of two words, of one and of none
(the root) that training texts hold; an arc leaves a state for every word seen after it and leads to the longest history
known afterwards, and a failure arc leads to the history without its first word. With c(h, w) continuations of a history,
c(h) their sum, P(w) = (c(w) + 1) / (N + V + 1) at the root and h' the history without its first word

    arc h -> w:  P(w | h) = (c(h, w) + strength P(w | h')) / (c(h) + strength)
    failure arc: strength / (c(h) + strength)

so every state's arcs and what it passes on sum to 1. A text is read once from left to right: the state is carried from
word to word, failure arcs are followed until an arc fits, and the logarithms add up. An unknown word is an arc of the
root that leads back to it.

The automaton grows with the corpus, so it is never held whole. Texts are written once as blocks of word numbers; each
block asks for the counts of its distinct words, pairs and triples, which are added up by hash range, and gets back just
the slice of the automaton that its texts can touch.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.llm.common import by_bytes, mix64, pack, pack_sorted, partitions, unpack, unpack_sorted
from driftwarden.runtime import cut

BLOCK_BYTES = 8_000_000
#: Bytes of text per bucket of counts, on average.
BUCKET_BYTES = 8_000_000
#: Bits of a key beyond those that number the corpus' bytes: a word or n-gram shares its key with odds of 2^-20 at any size.
SPARE_BITS = 20
END, START = np.uint64(1), np.uint64(2)  # keys of the end token and of the start state


def power_of_two(n: int) -> int:
    return 1 << max(0, int(n - 1).bit_length())


def key_mask(size: int) -> np.uint64:
    """Keeps the leading bits of a hash that texts of ``size`` bytes need."""
    bits = min(64, int(size).bit_length() + SPARE_BITS)
    return np.uint64(((1 << bits) - 1) << (64 - bits))


def slices(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of the ascending ``keys`` in each of ``buckets`` (a power of two) equal hash ranges."""
    bits = buckets.bit_length() - 1
    at = np.searchsorted(keys >> np.uint64(64 - bits), np.arange(buckets, dtype=np.uint64)) if bits else np.zeros(1, int)
    return np.concatenate((at, [len(keys)]))


def encode_blocks(docs: DataFrame, mask: np.uint64) -> DataFrame:
    """block, ids, missing, held, lengths, words (distinct keys, ascending), codes (number of each token's word)."""

    def encode(frames):
        part, number = TaskContext.get().partitionId() << 32, 0
        for whole in frames:
            for a, b in by_bytes([len(t) if t else 0 for t in whole["text"]], BLOCK_BYTES):
                frame = whole.iloc[a:b]
                tokens = [t.encode().lower().split() if t else [] for t in frame["text"]]
                lengths = np.array([len(t) + 1 for t in tokens], np.int32)
                ends = np.cumsum(lengths, dtype=np.int64) - 1
                keys = np.full(int(lengths.sum()), END, np.uint64)
                inner = np.ones(len(keys), bool)
                inner[ends] = False
                flat = np.empty(int(inner.sum()), dtype=object)
                flat[:] = [w for t in tokens for w in t]
                if len(flat):
                    codes, names = pd.factorize(flat)
                    keys[inner] = pd.util.hash_array(np.asarray(names, dtype=object), categorize=False)[codes] & mask
                words, codes = np.unique(keys, return_inverse=True)
                ids = [int(x) if x is not None else 0 for x in frame["id"]]
                yield pd.DataFrame({
                    "block": [part + number], "ids": [pack(np.array(ids, np.int64))],
                    "missing": [pack(frame["id"].isna().to_numpy().astype(np.uint8))],
                    "held": [pack(frame["held"].to_numpy().astype(np.uint8))], "lengths": [pack(lengths)],
                    "words": [pack_sorted(words)], "codes": [pack(codes.astype(np.int32))]})
                number += 1

    id_text = F.col("doc_id").cast("string")
    held = F.coalesce(F.crc32(id_text.cast("binary")) % 7 == 2, F.lit(False))
    return docs.select(id_text.alias("id"), held.alias("held"), "text").mapInPandas(
        encode, "block long, ids binary, missing binary, held binary, lengths binary, words binary, codes binary")


def _read(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, codes, lengths, held) of a block."""
    return (unpack_sorted(row["words"]), unpack(row["codes"], np.int32), unpack(row["lengths"], np.int32),
            unpack(row["held"], np.uint8).astype(bool))


def _grams(words: np.ndarray, codes: np.ndarray, lengths: np.ndarray, order: int,
           mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(keys, places): the n-gram of ``order`` words that ends at each token; a text's first tokens follow its start."""
    places = np.arange(len(codes))
    if order == 1:
        return words[codes], places
    first = np.cumsum(lengths, dtype=np.int64) - lengths
    start = mix64(np.array([START]))[0]
    with np.errstate(over="ignore"):
        spread = mix64(words)
        before = np.empty(len(codes), np.uint64)
        before[1:] = spread[codes[:-1]]
        before[first] = start
        keys = mix64(before * np.uint64(3) + spread[codes])
        if order == 2:
            return keys & mask, places
        earlier = np.empty(len(codes), np.uint64)
        earlier[1:] = before[:-1]
        inside = np.ones(len(codes), bool)
        inside[first] = False
        return mix64(earlier * np.uint64(5) + keys)[inside] & mask, places[inside]


def _requests(blocks: DataFrame, order: int, buckets: int, mask: np.uint64) -> DataFrame:
    """bucket, block, keys, counts: the distinct keys of each block and how often training texts have them."""

    def ask(frames):
        for frame in frames:
            for _, row in frame.iterrows():
                words, codes, lengths, held = _read(row)
                learn = np.repeat(~held, lengths)
                if order == 1:
                    keys = words
                else:
                    grams, places = _grams(words, codes, lengths, order, mask)
                    keys, codes = np.unique(grams, return_inverse=True)
                    learn = learn[places]
                counts = np.bincount(codes[learn], minlength=len(keys)).astype(np.uint32)
                cuts = slices(keys, buckets)
                at = np.flatnonzero(np.diff(cuts))
                yield pd.DataFrame({
                    "bucket": at, "block": row["block"],
                    "keys": [pack_sorted(keys[cuts[k]:cuts[k + 1]]) for k in at],
                    "counts": [pack(counts[cuts[k]:cuts[k + 1]]) for k in at]})

    return blocks.mapInPandas(ask, "bucket int, block long, keys binary, counts binary")


class Automaton:
    """The slice of the automaton that a block's texts can touch.

    State 0 is the root, 1 + u the history of word number u (after the last word: the start of a text), and from
    ``pairs`` on come the histories of two words. ``counts`` holds the training counts of the block's distinct words,
    pairs and triples in the order of their keys, ``n`` tokens and ``v`` words make up the training texts.
    """

    def __init__(self, words: np.ndarray, codes: np.ndarray, lengths: np.ndarray, counts: list[np.ndarray],
                 n: int, v: int, strength: float, mask: np.uint64):
        m = len(words)
        self.pairs, self.width = m + 2, m + 1
        singles, doubles, triples = (c.astype(np.float64) for c in counts)
        ends = singles[words == END]
        history = np.concatenate((singles, ends if len(ends) else [0.0]))
        self.start = 1 + m if history[m] else 0
        self.plain = (singles + 1) / (n + v + 1)

        self.codes, self.first = codes, np.cumsum(lengths, dtype=np.int64) - lengths
        grams, _ = _grams(words, codes, lengths, 2, mask)
        _, at, pair_of = np.unique(grams, return_index=True, return_inverse=True)
        before = np.empty(len(codes), np.int64)
        before[1:] = codes[:-1]
        before[self.first] = m
        first, second = before[at], codes[at].astype(np.int64)
        by_pair = (doubles + strength * self.plain[second]) / (history[first] + strength)

        grams, places = _grams(words, codes, lengths, 3, mask)
        _, at, triple_of = np.unique(grams, return_index=True, return_inverse=True)
        end = places[at]
        longer, shorter = pair_of[end - 1], pair_of[end]
        by_triple = (triples + strength * by_pair[shorter]) / (doubles[longer] + strength)

        two, three = np.flatnonzero(doubles), np.flatnonzero(triples)
        self.source = np.concatenate((np.zeros(m, np.int64), 1 + first[two], self.pairs + longer[three]))
        self.word = np.concatenate((np.arange(m), second[two], codes[end[three]]))
        self.target = np.concatenate((np.where(singles > 0, 1 + np.arange(m), 0), self.pairs + two, self.pairs + shorter[three]))
        self.weight = np.log10(np.concatenate((self.plain, by_pair[two], by_triple[three])))
        self.failure = np.concatenate(([0], np.zeros(m + 1, np.int64), 1 + second))
        passed = strength / (np.concatenate((history, doubles)) + strength)
        self.passes = np.log10(np.concatenate(([1.0], passed)))
        # the arcs that read each place's last two and three words, -1 where there is none
        self.arc_of_two = _numbered(two, len(doubles), m)[pair_of]
        self.arc_of_three = np.full(len(codes), -1)
        self.arc_of_three[places] = _numbered(three, len(triples), m + len(two))[triple_of]

    @functools.cached_property
    def arcs(self) -> dict[int, int]:
        """The number of the arc that leaves a state for a word, by state * width + word."""
        return dict(zip((self.source * self.width + self.word).tolist(), range(len(self.source))))

    def read(self, text: list[int]) -> float:
        """log10 of the probability of one text, given as word numbers, word by word."""
        state, total = self.start, 0.0
        for word in text:
            arc = self.arcs.get(state * self.width + word)
            while arc is None:  # the root has an arc for every word
                total += self.passes[state]
                state = self.failure[state]
                arc = self.arcs.get(state * self.width + word)
            total += self.weight[arc]
            state = self.target[arc]
        return total

    def read_all(self) -> np.ndarray:
        """What ``read`` gives for every text of the block, all words at once.

        All arcs that read a word after the same history lead to the longest one known afterwards, so the state carried
        to a place is the target of the longest arc that reads the place before; from there failure arcs are followed
        until an arc fits, twice at most. Costs are added up in the order of the text.
        """
        longest = np.where(self.arc_of_two >= 0, self.arc_of_two, self.codes)
        state = np.empty(len(longest), np.int64)
        state[1:] = self.target[longest[:-1]]
        state[self.first] = self.start
        costs = np.zeros((len(state), 3))
        arc = np.where(state >= self.pairs, self.arc_of_three, -1)
        fails = (state >= self.pairs) & (arc < 0)
        costs[fails, 0] = self.passes[state[fails]]
        state[fails] = self.failure[state[fails]]
        single = (arc < 0) & (state > 0)
        arc[single] = self.arc_of_two[single]
        fails = single & (arc < 0)
        costs[fails, 1] = self.passes[state[fails]]
        arc = np.where(arc < 0, self.codes, arc)  # the root's arcs
        costs[:, 2] = self.weight[arc]
        place = np.zeros(len(state), np.int64)
        place[self.first[1:]] = 1
        return np.bincount(np.repeat(np.cumsum(place), 3), costs.ravel(), len(self.first))


def _numbered(places: np.ndarray, size: int, start: int) -> np.ndarray:
    """start, start + 1, ... at ``places``, -1 elsewhere."""
    out = np.full(size, -1)
    out[places] = start + np.arange(len(places))
    return out


def _answers(requests: DataFrame, kind: int) -> DataFrame:
    """block, kind, bucket, counts (total of every key asked for), tokens and types of the bucket (block null)."""

    def add(key, frame):
        keys = [unpack_sorted(k) for k in frame["keys"]]
        sizes = np.array([len(k) for k in keys])
        every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([unpack(c, np.uint32) for c in frame["counts"]])
        total = np.bincount(inverse, counts, len(every)).astype(np.int64)
        ends = np.cumsum(sizes)
        out = pd.DataFrame({
            "block": frame["block"].astype("Int64"), "kind": kind, "bucket": key[0],
            "counts": [pack(total[inverse[e - n:e]]) for e, n in zip(ends, sizes)],
            "tokens": 0, "types": 0})
        whole = pd.DataFrame({"block": pd.array([None], "Int64"), "kind": kind, "bucket": key[0], "counts": [None],
                              "tokens": int(total.sum()), "types": int((total > 0).sum())})
        return pd.concat([out, whole])

    return requests.groupBy("bucket").applyInPandas(
        add, "block long, kind int, bucket int, counts binary, tokens long, types long")


def score_documents(docs: DataFrame, strength: float = 30.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10) of every row.

    Training texts are those whose crc32(doc_id) mod 7 is not 2; a null id counts as training. A null or empty text
    is its end token alone. Repeated rows are counted and scored as often as they occur. An unknown word leads to the
    root and costs its share of P. An empty table gives no rows. Memory follows the longest text.
    """
    spark = docs.sparkSession
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = power_of_two(max(4 * partitions(spark), -(-held // BUCKET_BYTES)))
    mask = key_mask(held)
    blocks = cut(encode_blocks(docs, mask), "lm-blocks")
    words = cut(_answers(_requests(blocks, 1, buckets, mask), 1), "lm-words")
    longer = [_answers(_requests(blocks, order, buckets, mask), order) for order in (2, 3)]
    size = words.where("block is null").agg(F.sum("tokens").alias("n"), F.sum("types").alias("v")).first()
    n, v = size["n"] or 0, size["v"] or 0
    answers = words.unionByName(longer[0]).unionByName(longer[1]).where("block is not null").select(
        F.col("block").alias("of"), "kind", "bucket", "counts")

    def walk(key, block, answer):
        if not len(block):
            return pd.DataFrame({"doc_id": pd.array([], "Int64"), "held_out": [], "n_tokens": [], "n_known": [],
                                 "base_score": [], "score": []})
        answer = answer.sort_values(["kind", "bucket"])
        counts = [np.concatenate([np.empty(0, np.int64), *(unpack(c, np.int64) for c in answer["counts"][answer["kind"] == k])])
                  for k in (1, 2, 3)]
        row = block.iloc[0]
        names, codes, lengths, held = _read(row)
        automaton = Automaton(names, codes, lengths, counts, n, v, strength, mask)
        ends = np.cumsum(lengths, dtype=np.int64)
        first = ends - lengths
        known = (counts[0] > 0)[codes]
        ids = pd.array(unpack(row["ids"], np.int64), "Int64")
        ids[unpack(row["missing"], np.uint8).astype(bool)] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": held, "n_tokens": lengths.astype(np.int64),
            "n_known": np.add.reduceat(known.astype(np.int64), first),
            "base_score": np.add.reduceat(np.log10(automaton.plain)[codes], first),
            "score": automaton.read_all()})

    scored = blocks.groupBy("block").cogroup(answers.groupBy("of")).applyInPandas(
        walk, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         "base_score", "score")
