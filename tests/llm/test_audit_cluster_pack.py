"""Divergence audit, centroid clustering and packing against plain versions, on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

from driftwarden.llm import divergence, packing, vafile
from tests.llm import helpers as h

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    return h.awkward_documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return h.documents(spark, rows)


# 11
def plain_audit(rows, least, top):
    seen, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        seen[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang, df in seen.items():
        kept = [t for t, n in df.items() if n >= least]
        groups = {s: [c[t] for t in kept] for (a, s), c in counts.items() if a == lang}

        def shares(values):
            return [1 + 10 ** 9 * (n + 5) // (sum(values) + 5 * len(kept)) for n in values]

        p = {s: shares(v) for s, v in groups.items()}
        q = shares([sum(v) for v in zip(*groups.values())])
        for s in groups:
            pairs = [(-sum(abs(x - y) for x, y in zip(p[s], p[o])), o) for o in groups if o != s]
            terms = [(y - x, t) for t, n, x, y in zip(kept, groups[s], p[s], q) if n and x > y]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(items)]
    return out


@pytest.mark.parametrize("least,top", [(30, 50), (3, 7)])
def test_audit_equals_plain_version(spark, docs, rows, least, top):
    got = divergence.audit_sources(spark, docs, least, top).collect()
    want = plain_audit([(r[1], r[2], r[3]) for r in rows], least, top)
    assert h.ordered(got) == h.ordered(want)
    assert {r[2] for r in want} == {"pair", "term"}


def test_audit_with_small_shards_passes_and_tiles(spark, docs, rows, monkeypatch):
    for name, value in (("SHARD_TERMS", 40), ("TILE", 3), ("PASS_BYTES", 20_000), ("HELD_TERMS", 500),
                        ("HELD_SLOT_BYTES", 3_000), ("FAN_IN", 2)):
        monkeypatch.setattr(divergence, name, value)
    got = divergence.audit_sources(spark, docs, 3, 7).collect()
    assert h.ordered(got) == h.ordered(plain_audit([(r[1], r[2], r[3]) for r in rows], 3, 7))


def test_audit_of_nothing_and_of_texts_without_terms(spark):
    assert divergence.audit_sources(spark, h.documents(spark, []).coalesce(1)).count() == 0
    bare = [(1, "12 34", "en", "a", 5, 0, "", ""), (2, None, "en", "b", 5, 0, "", ""), (3, "", None, None, 5, 0, "", "")]
    got = divergence.audit_sources(spark, h.documents(spark, bare)).collect()
    assert h.ordered(got) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_perfect_hash_is_minimal_and_knows_strangers():
    terms = [f"w{i * i}".encode() for i in range(3000)]
    shard = {"lang": "en", "shards": 1, "shard": 0, **divergence.build_hash(terms)}
    found = divergence.PerfectHashes([shard])
    number, slot = found.look_up("en", terms + [b"stranger", b"w", "é".encode()])
    assert sorted(slot[:3000].tolist()) == list(range(3000)) and set(slot[3000:]) == {-1} and set(number[:3000]) == {0}
    assert set(found.look_up("de", [b"w1"])[1]) == {-1}


def test_terms_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda t, seed: 7)
    terms = [b"a", b"bb", b"cc"]
    shard = {"lang": "", "shards": 1, "shard": 0, **divergence.build_hash(terms)}
    assert shard["rest"] == 3
    found = divergence.PerfectHashes([shard])
    assert found.look_up("", [b"cc", b"a", b"dd", b"bb"])[1].tolist() == [2, 0, -1, 1]


def test_hashes_are_those_of_spark(spark):
    words = ["", "a", "straße", "x" * 100]
    got = spark.createDataFrame([(w.encode(),) for w in words], "w binary").select(F.xxhash64("w")).collect()
    own = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in words], np.uint64)
    assert [r[0] for r in got] == own.view(np.int64).tolist()


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 1, 10 ** 12 + 7, 3 * 10 ** 15], np.int64)
    total, terms = 4 * 10 ** 15, 10 ** 6
    assert divergence.shares(counts, total, terms).tolist() == [
        1 + 10 ** 9 * (int(c) + 5) // (total + 5 * terms) for c in counts]


# 12
def vectors():
    found = [(v, lab, e) for v, e, lab in h.table("embeddings")]
    one = found[0]
    return found + [(5001, 1, one[2]), (5001, 1, one[2]), (None, 1, found[1][2]), (5002, None, [0.0] * 64), (5003, 1, None),
                    (5004, 1, [float("nan")] + [1.0] * 63), (5005, 1, [None] + [1.0] * 63), (5006, 1, [1.0, 2.0]), (5007, 1, []),
                    (5008, 1, [float("-inf")] * 64), (5009, 1, [300_000.0, -300_000.0] * 32), (5010, 1, [3e38] * 64)]


def plain_clusters(rows, k, rounds):
    kept = [(v, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for v, _, e in rows
            if e is not None and len(e) == 64 and all(x is not None and abs(x) < 2 ** 19 for x in e)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c, q = np.array([x for _, x in first[:k]]), np.array([x for _, x in kept])
    for i in range(rounds + 1):
        d = ((q[:, None, :] - c) ** 2).sum(2)
        a = d.argmin(1)
        if i < rounds:
            c = np.array([q[a == j].sum(0) // (a == j).sum() if (a == j).any() else c[j] for j in range(len(c))])
    near = [int(x) for x in d.min(1)]
    inertia = [sum(n for n, b in zip(near, a) if b == j) for j in range(len(c))]
    names = [hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest() for x in c]
    return [(v, int(j), n, inertia[j], sum(near), names[j]) for (v, _), j, n in zip(kept, a, near)]


@pytest.mark.parametrize("k,rounds,bits", [(40, 5, 6), (7, 3, 2), (3, 0, 8)])
def test_clusters_equal_plain_version(spark, k, rounds, bits):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in vectors()],
                                  "vec_id long, label int, embedding array<float>, row int, q string, cluster string")
    got = vafile.cluster_vectors(spark, frame.repartition(3), k, rounds, bits=bits).collect()
    assert h.ordered(got) == h.ordered(plain_clusters(vectors(), k, rounds))


def test_settled_cells_are_right_and_spare_full_vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(-100, 100, (4, 64))
    q = (centres[rng.integers(0, 4, 400)] + rng.integers(-3, 4, (400, 64))).astype(np.int64)
    edges = np.linspace(q.min(0), q.max(0) + 1, 65).T.astype(np.int64)
    tables, norm = vafile.Intervals(edges, centres), (q * q).sum(1)
    cells = vafile.unpack_cells(vafile.pack_cells(q, edges, 6), 64, 6)
    open_ = tables.candidates(cells, norm)
    assert open_[np.arange(400), ((q[:, None] - centres) ** 2).sum(2).argmin(1)].all() and (open_.sum(1) == 1).mean() > 0.9


def test_clusters_of_nothing_and_of_few(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert vafile.cluster_vectors(spark, spark.createDataFrame([], schema)).count() == 0
    few = [(1, 0, [0.5] * 64), (2, 0, [0.5] * 64), (3, 0, [-0.25] * 64)]
    got = vafile.cluster_vectors(spark, spark.createDataFrame(few, schema)).collect()
    assert h.ordered(got) == h.ordered(plain_clusters([(v, b, e) for v, b, e in few], 40, 5))


# 13
def whole_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_packing_equals_plain_version(spark, docs, rows):
    packed = packing.pack_documents(spark, docs, VOCABULARY, keep_ids=True)
    got = packed.collect()
    want = []
    for row, ids in zip(rows, whole_ids([r[1] for r in rows])):
        edges = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        want += [(row[0], i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                 for i, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert h.ordered(r[:5] for r in got) == h.ordered(want)
    filled = defaultdict(list)
    for r in got:
        filled[r["sequence_id"]].append((r["offset"], r["length"], bytes(r["ids"])))
    for parts in filled.values():
        parts.sort()
        assert [o for o, _, _ in parts] == [sum(n for _, n, _ in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n, _ in parts) <= 2048
    assert len(filled) <= 1.02 * sum(r[3] for r in want) / 2048 + 1
    whole = {r["sequence_id"]: (r["length"], bytes(r["ids"])) for r in packing.sequences(packed).collect()}
    assert whole == {s: (sum(n for _, n, _ in p), b"".join(i for _, _, i in p)) for s, p in filled.items()}


def test_packing_of_nothing(spark):
    assert packing.pack_documents(spark, h.documents(spark, []).coalesce(1), VOCABULARY).count() == 0


def test_plan_is_best_fit(spark):
    rng = random.Random(1)
    for _ in range(100):
        capacity = rng.choice([1, 5, 8, 50])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 150))]
        rooms = []
        for x in sorted(items, reverse=True):
            fit = [r for r in rooms if r >= x]
            if fit:
                rooms[rooms.index(min(fit))] -= x
            else:
                rooms.append(capacity - x)
        filled, ranks = defaultdict(list), defaultdict(list)
        for length, a, b, first, per, offset in packing.plan_slots(Counter(items), capacity):
            for j in range(b - a):
                filled[first + j // per].append((offset + j % per * length, length))
                ranks[length].append(a + j)
        assert sorted(capacity - sum(n for _, n in p) for p in filled.values()) == sorted(rooms)
        assert {x: list(range(n)) for x, n in Counter(items).items()} == {x: sorted(r) for x, r in ranks.items()}


def test_words_have_the_ids_of_their_text(monkeypatch):
    monkeypatch.setattr(packing, "SLICE_CHARS", 60)
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    rng = random.Random(2)
    pool = [" ", " ", "  ", "a", " b", "'", "'s", "É", "×", "ɐ", "²", "\n", "\r\n", "\t", "\x1c", "\x85", "12", ".", "漢", "🙂",
            "<|endoftext|>", "\x00", " word", " other"]
    texts = ["".join(rng.choice(pool) for _ in range(n)) for n in range(200)]
    encoder = packing.Encoder(VOCABULARY)
    for _ in range(2):
        got = [[*np.frombuffer(b, "<u4").tolist(), 0] for b in encoder.encode(texts)]
        assert got == whole_ids(texts)


def test_words_with_marks_are_learned_as_columns():
    rng = random.Random(3)
    letters = ["a", "word", "Größe", "École", "naïve", "of", "x" * 70, "ſ", "Ɏ"]
    marks = ["", ",", ".", "!?", "&&&", "\"", "'", "'s", ")..", "_", "`~", "\\", "\n", "…", "1"]
    texts = [" ".join(rng.choice(letters) + rng.choice(marks) for _ in range(n)) for n in range(1, 120)]
    encoder = packing.Encoder(VOCABULARY)
    got = [[*np.frombuffer(b, "<u4").tolist(), 0] for part in (texts[:60], texts[60:]) for b in encoder.encode(part)]
    assert got == whole_ids(texts)
    columns = packing.Encoder(VOCABULARY)
    columns.encode(["of Größe, word&&&"])
    assert not {" Größe,", " word&&&"} & set(columns.young) and "word&&&" in columns.known.to_pylist()
