"""Best-fit packing of documents into sequences, planned over counts of lengths.

Documents become pieces of at most ``capacity`` tokens, and only the number of pieces of each length matters for a plan:
best-fit runs over at most ``capacity`` counts, longest first, and treats all sequences with the same room as one range
of numbers. Pieces then take their planned slot by their rank among the pieces of their length. Tokens are made once;
only thin rows are shuffled, and no task sees all pieces of a length.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwarden.llm.common import by_bytes, ranges
from driftwarden.runtime import cut

END_ID = 0
BATCH_BYTES = 4_000_000
#: Characters of a text that are split into words at once.
SLICE_CHARS = 200_000
#: Words kept with their ids, in each of two generations, and the longest word kept.
CACHED_WORDS, CACHED_CHARS = 300_000, 40
# a blank at an end of the text or beside white space; the first for texts one by one, the second for columns of them
_AT_BLANK = re.compile(r"[^\S ] | [^\S ]|\A | \Z")
_WHITE = r"[\t-\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD_BLANK = rf"(?:\A|{_WHITE}) | (?:{_WHITE}|\z)|\x00"
# fixed: how the vocabulary cuts a text into tokens, for texts of ASCII and Latin letters alone
_LATIN = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F"
_LATIN_TEXT = re.compile(f"[\\x00-\\x1B\\x20-\\x7F{_LATIN}]*")  # Python counts 1C-1F as white space, the vocabulary does not
_LATIN_TOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s0-9{_LATIN}]+|\s+(?!\S)|\s+")
# fixed: the character that stands for each byte in the vocabulary
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_BYTE_CHARACTERS = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}
_SPELLED = np.array([ord(_BYTE_CHARACTERS.get(b, chr(b))) for b in range(256)], "<u4")
_SPELLED[10] = 10  # words stand one to a line
# letters and ASCII marks without an apostrophe behind them: two tokens of the vocabulary's pattern, or one
_WORD_AND_MARKS = rf"^(?P<letters>[{_LATIN}]+)(?P<marks>[!-&(-/:-@\[-`{{-~]*)\z"
PLAN_SCHEMA = "length int, from_rank long, to_rank long, first_sequence long, per_sequence long, first_offset long"


class Encoder:
    """Ids of texts by a byte-level BPE vocabulary file, words taken from a bounded cache.

    The vocabulary's pattern always ends a token before a blank that stands between two characters that are not white
    space, so the words between such blanks have ids of their own; they are joined to the ids of the text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker per core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.of_tokens = Tokenizer(self.tokenizer.model)  # for tokens that are cut out and spelled in bytes already
        self.of_tokens.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a character stands for a byte
        self.token_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # words of plain texts as they are cut, and where their ids lie; ``used`` is the turn a word was last seen in
        self.known, self.ids = pa.array([], pa.string()), np.zeros(0, "<u4")
        self.starts, self.sizes, self.used = (np.zeros(0, np.int64) for _ in range(3))
        self.turn = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        column = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(column, _ODD_BLANK).to_pylist()
        plain = [i for i, t in enumerate(texts) if not odd[i] and len(t) <= 10 * SLICE_CHARS]
        out: list[bytes] = [b""] * len(texts)
        for i, data in zip(plain, self._plain([texts[i] for i in plain])):
            out[i] = data
        for i in sorted(set(range(len(texts))) - set(plain)):
            out[i] = self._one(texts[i])
        if len(self.young) > CACHED_WORDS:
            self.old = {w: i for w, i in self.young.items() if len(w) <= CACHED_CHARS}
            self.young = {}
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Texts whose every blank starts a token: distinct words are looked up once for all of them."""
        if not texts:
            return []
        lists = pc.split_pattern(pa.array(["\0" + t for t in texts]), " ")  # the mark tells first words from others
        coded = lists.flatten().dictionary_encode()
        place = pc.index_in(coded.dictionary, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(self.known) + np.arange(len(new))
            self._add(coded.dictionary.take(pa.array(new)))
        self.turn += 1
        self.used[place] = self.turn
        at = place[coded.indices.to_numpy()]
        counts = self.sizes[at]
        flat = self.ids[ranges(self.starts[at], counts)]
        stops = np.concatenate([[0], np.cumsum(counts)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        if len(self.known) > CACHED_WORDS or len(self.ids) > CACHED_CHARS * CACHED_WORDS:
            self._forget()
        return [flat[a:b].tobytes() for a, b in zip(stops, stops[1:])]

    def _add(self, pieces: pa.Array) -> None:
        """Learn pieces that follow a blank or, behind a mark, open a text."""
        parts = pc.extract_regex(pieces, _WORD_AND_MARKS)
        simple = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        others = np.flatnonzero(~simple)
        words = [w[1:] if w[:1] == "\0" else " " + w for w in pieces.take(pa.array(others)).to_pylist()]
        self._learn({w for w in words if w not in self.young})
        found = [self.young[w] for w in words]
        counts, flat = np.zeros(len(pieces), np.int64), [np.frombuffer(b"".join(found), "<u4")]
        counts[others] = [len(i) // 4 for i in found]
        if simple.any():
            parts = parts.filter(pa.array(simple)).flatten()
            counts[simple], ids = self._two_tokens(*(p.dictionary_encode() for p in parts))
            flat.append(ids)
        starts = np.zeros(len(pieces), np.int64)
        order = np.concatenate([others, np.flatnonzero(simple)])
        starts[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, counts])
        self.used = np.concatenate([self.used, np.zeros(len(pieces), np.int64)])
        self.ids = np.concatenate([self.ids, *flat])
        self.known = pa.concat_arrays([self.known, pieces])

    def _two_tokens(self, letters: pa.DictionaryArray, marks: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, their ids): a blank with letters is a token, marks behind them are another."""
        names = letters.dictionary
        place = pc.index_in(names, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = np.flatnonzero(place < 0)
        fresh_ids, fresh_sizes = self._ids_after_blank(names.take(pa.array(new)))
        known = place >= 0
        starts, sizes = np.zeros((2, len(names)), np.int64)
        starts[known], sizes[known] = self.starts[place[known]], self.sizes[place[known]]
        starts[new], sizes[new] = len(self.ids) + np.cumsum(fresh_sizes) - fresh_sizes, fresh_sizes
        signs = marks.dictionary.to_pylist()
        self._learn({m for m in signs if m and m not in self.young})
        behind = [self.young[m] if m else b"" for m in signs]
        sign_sizes = np.array([len(i) // 4 for i in behind], np.int64)
        sign_starts = len(self.ids) + len(fresh_ids) + np.cumsum(sign_sizes) - sign_sizes
        pool = np.concatenate([self.ids, fresh_ids, np.frombuffer(b"".join(behind), "<u4")])
        first, second = letters.indices.to_numpy(), marks.indices.to_numpy()
        at = np.stack([starts[first], sign_starts[second]], 1).ravel()
        counts = np.stack([sizes[first], sign_sizes[second]], 1)
        return counts.sum(1), pool[ranges(at, counts.ravel())]

    def _ids_after_blank(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of words of letters alone that follow a blank."""
        ids, counts = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        sizes = pc.binary_length(words).to_numpy().astype(np.int64) + 1
        for a, b in by_bytes(sizes.tolist(), SLICE_CHARS):
            raw = np.frombuffer((" " + "\n ".join(words.slice(a, b - a).to_pylist())).encode(), np.uint8)
            own, stops = self._spelled_ids(_SPELLED[raw].tobytes().decode("utf-32-le"), np.cumsum(sizes[a:b]))
            ids.append(own)
            counts.append(np.diff(stops, prepend=0))
        return np.concatenate(ids), np.concatenate(counts)

    def _forget(self) -> None:
        """Keep the short words that were seen last, half as many as are held."""
        short = np.flatnonzero(pc.utf8_length(self.known).to_numpy() <= CACHED_CHARS)
        keep = np.sort(short[np.argsort(-self.used[short], kind="stable")[:CACHED_WORDS // 2]])
        sizes = self.sizes[keep]
        self.ids = self.ids[ranges(self.starts[keep], sizes)]
        self.known, self.used = self.known.take(pa.array(keep)), self.used[keep]
        self.starts, self.sizes = np.cumsum(sizes) - sizes, sizes

    def _one(self, text: str) -> bytes:
        found = []
        for part in _slices(text):
            words = self._words(part)
            self._learn({w for w in words if w not in self.young})
            found.append(b"".join(map(self.young.__getitem__, words)))
        return b"".join(found)

    def _words(self, text: str) -> list[str]:
        """The text cut before every blank that surely starts a token."""
        pieces = text.split(" ")
        words = [" " + p for p in pieces]
        words[0] = pieces[0]
        if "  " in text or _AT_BLANK.search(text):
            joined = [words[0]]
            for before, piece, word in zip(pieces, pieces[1:], words[1:]):
                if not before or not piece or before[-1].isspace() or piece[0].isspace():
                    joined[-1] += word
                else:
                    joined.append(word)
            words = joined
        return words

    def _learn(self, words: set[str]) -> None:
        """All ``words`` are in the young generation afterwards."""
        tokens, others, cut_up = set(), [], []
        for word in words:
            known = self.old.get(word)
            if known is not None:
                self.young[word] = known
            elif word.isascii() and word[1:].isalpha() and word[0] == " ":  # a token as it stands
                tokens.add(word)
            elif _LATIN_TEXT.fullmatch(word):
                own = _LATIN_TOKEN.findall(word)
                cut_up.append((word, own))
                tokens.update(own)
            else:
                others.append(word)
        plain, odd = [], []
        for token in tokens:
            known = self.young.get(token) or self.old.get(token)
            if known is not None:
                self.young[token] = known
            elif token.isascii() and token.isprintable():
                plain.append(token)
            else:
                odd.append(token)
        for a, b in by_bytes(list(map(len, plain)), SLICE_CHARS):
            self._token_ids(plain[a:b], "\n".join(plain[a:b]).replace(" ", _BYTE_CHARACTERS[32]), map(len, plain[a:b]))
        for a, b in by_bytes(list(map(len, odd)), SLICE_CHARS):
            raw = [t.encode() for t in odd[a:b]]
            spelled = "\n".join(t.decode("latin-1").translate(_BYTE_CHARACTERS) for t in raw)
            self._token_ids(odd[a:b], spelled, map(len, raw))
        for word, own in cut_up:
            if len(own) != 1:
                self.young[word] = b"".join([self.young[t] for t in own])
        for word in others:
            ids = self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids
            self.young[word] = np.array(ids, "<u4").tobytes()

    def _token_ids(self, tokens: list[str], spelled: str, sizes) -> None:
        """Learn ``tokens``, given by the characters for their bytes, one to a line, and their numbers of bytes."""
        ids, stops = self._spelled_ids(spelled, np.cumsum(list(sizes)))
        stops, data = (4 * stops).tolist(), ids.tobytes()
        self.young.update(zip(tokens, [data[a:b] for a, b in zip([0, *stops], stops)]))

    def _spelled_ids(self, spelled: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, where each token's ids end) of tokens whose bytes end at ``ends``."""
        ids = np.array(self.of_tokens.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
        return ids, np.searchsorted(np.cumsum(self.token_bytes[ids]), ends, side="right")


def _slices(text: str) -> Iterator[str]:
    """Pieces of a long text, cut before a blank between two characters that are not white space."""
    start = 0
    while len(text) - start > SLICE_CHARS:
        at = text.find(" ", start + SLICE_CHARS)
        while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
            at = text.find(" ", at + 1)
        if at < 0 or at == len(text) - 1:
            break
        yield text[start:at]
        start = at
    yield text[start:]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces_of(docs: DataFrame, path: str, capacity: int = 2048, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part, rank (and ids): the pieces of every document.

    A document longer than ``capacity`` is cut into whole pieces behind a first, perhaps shorter, one. ``part`` is the
    task that made the piece and ``rank`` counts the pieces of this length in it, from 0.
    """
    fields = [pa.field("doc_id", pa.int64()), pa.field("piece", pa.int32()), pa.field("start", pa.int64()),
              pa.field("length", pa.int32()), pa.field("ids_crc32", pa.int64()), pa.field("part", pa.int32()),
              pa.field("rank", pa.int64())] + ([pa.field("ids", pa.binary())] if keep_ids else [])
    schema = pa.schema(fields)

    def cut_up(batches):
        encoder, part, seen = _encoder(path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            for a, b in by_bytes(pc.binary_length(batch.column(1)).fill_null(0).to_pylist(), BATCH_BYTES):
                rows = [[] for _ in fields]
                ids, texts = (column.slice(a, b - a).to_pylist() for column in batch.columns)
                found = encoder.encode([(t or b"").decode("utf-8", "replace") for t in texts])
                for doc_id, data in zip(ids, found):
                    data = memoryview(data + END_ID.to_bytes(4, "little"))
                    total = len(data) // 4
                    edges = [0, *range((total - 1) % capacity + 1, total + 1, capacity)]
                    for i, (start, stop) in enumerate(zip(edges, edges[1:])):
                        own = data[4 * start:4 * stop]
                        row = [doc_id, i, start, stop - start, zlib.crc32(own), part, seen[stop - start]]
                        seen[stop - start] += 1
                        for column, value in zip(rows, [*row, bytes(own)]):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(r, f.type) for r, f in zip(rows, fields)], schema=schema)

    types = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, rank long"
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return texts.mapInArrow(cut_up, types + (", ids binary" if keep_ids else ""))


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from_rank, to_rank, first_sequence, per_sequence, first_offset): who of each length goes where.

    Best-fit, longest first, over counts: a piece goes to the fullest sequence that has room for it, else to a new one.
    A sequence that takes a piece is then the fullest with room, if it has room for another of that length; so each takes
    as many as fit before the next one does. Sequences of equal content are one range of numbers. Every length leaves at
    most four more ranges, and one that takes a piece has less than half of its room left, so the plan has at most
    ``4 capacity log2 capacity`` rows whatever the number of pieces.
    """
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> ranges (first sequence, sequences)
    heap: list[int] = []
    plan, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            if not rooms[room]:
                heapq.heappush(heap, room)
            rooms[room].append((first, n))

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[length]
        too_small = []
        while left:
            while heap and heap[0] < length:
                too_small.append(heapq.heappop(heap))
            if heap:
                room = heap[0]
                first, n = rooms[room].pop()
                if not rooms[room]:
                    heapq.heappop(heap)
            else:
                room, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            per = room // length
            whole = min(n, left // per)
            if whole:
                plan.append((length, rank, rank + whole * per, first, per, capacity - room))
                rank, left = rank + whole * per, left - whole * per
                put(room - per * length, first, whole)
            if left and whole < n:  # the last one takes what is left
                plan.append((length, rank, rank + left, first + whole, left, capacity - room))
                put(room - left * length, first + whole, 1)
                rank, left, whole = rank + left, 0, whole + 1
            put(room, first + whole, n - whole)
        for room in too_small:
            heapq.heappush(heap, room)
    return plan


def pack_documents(spark: SparkSession, docs: DataFrame, path: str, capacity: int = 2048,
                   keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids): the slot of every piece.

    A null or empty text is the end id alone; a null id stays null and repeated rows are packed one by one. Memory
    follows the longest run of a text without a blank between other characters; texts of any length are cut there.
    Extra columns are ignored, whatever their names. An empty table gives an empty result.
    """
    pieces = cut(pieces_of(docs, path, capacity, keep_ids), "pieces")
    counts = cut(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # a row per length: bounded by the capacity
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(plan_slots(total, capacity), PLAN_SCHEMA)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    slots = F.broadcast(plan.withColumnRenamed("length", "planned"))  # bounded by the capacity, see plan_slots
    inside = (F.col("length") == F.col("planned")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    at = F.col("rank") - F.col("from_rank")
    return ranked.join(slots, inside).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
        (F.col("first_sequence") + F.floor(at / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("first_offset") + at % F.col("per_sequence") * F.col("length")).alias("offset"),
        *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the ids of every sequence in order; ``packed`` holds ids. A group is one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
