"""Documents with awkward rows, and plain versions of the operators to compare with."""

import hashlib
import re
from collections import defaultdict

import duckdb

SF_DIR = "/root/testdata/sf0.001"
# extra columns whose names the operators use themselves
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, _source string, row string"


def table(name, sf_dir=SF_DIR):
    return duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'").fetchall()


def awkward_documents():
    """The smallest table, and rows with nulls, empty, blank and very long texts, ties and repeated rows."""
    rows = [tuple(r[:5]) for r in table("documents")]
    text = rows[0][1]
    long_text = " ".join(f"w{i * i % 9973}" for i in range(60_000))
    rows += [(10_001, None, "en", "src0", None), (10_002, "", None, None, 0), (10_003, " \t\n", "xx", "src1", 3),
             (10_004, text, "en", "src2", len(text)), (10_004, text, "en", "src2", len(text)),
             (10_005, long_text, "en", "src0", len(long_text)), (None, "one two three", "en", None, 13),
             (10_006, "Öne two", None, "", 7), (10_007, "a" * 5000, "de", "src3", 5000),
             (10_008, "ab " * 400, "de", "src3", 1200), (10_009, long_text + " tail", "en", "src9", 1)]
    return [(*r, 1, "clash", "clash") for r in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_documents() if rows is None else rows, SCHEMA).repartition(4)


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def roots(names, links):
    """{name: smallest name reachable}."""
    up = {n: n for n in names}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in names}


def words_ascii(text, pattern):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(pattern, lowered)


def brute_decontamination(docs, items, length=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for item, text in items:
        w = words_ascii(text, pattern)
        n = min(length, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows[tuple(w[i:i + n])].add(str(item))
    out = []
    for doc_id, text in docs:
        w, hit, ids = words_ascii(text, pattern), set(), set()
        for n in range(1, length + 1):
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    ids |= windows[tuple(w[i:i + n])]
        line = ",".join(sorted(ids))
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(line.encode()).hexdigest(), bool(hit)))
    return out


def shingles(text, width=4):
    w = words_ascii(text, r"[^\x20\x09-\x0D]+")
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute_jaccard(docs, width=4, percent=85):
    """[(doc_id, n_shingles, component_id)] with rows as nodes."""
    sets = [shingles(t, width) for _, t in docs]
    groups = defaultdict(list)
    for i, s in enumerate(sets):
        if s:
            groups[s].append(i)
    keys = list(groups)
    links = [(g[0], i) for g in groups.values() for i in g[1:]]
    for i, x in enumerate(keys):
        for y in keys[:i]:
            if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    links.append((groups[x][0], groups[y][0]))
    root = roots(range(len(docs)), links)
    members = defaultdict(list)
    for i in root:
        members[root[i]].append(docs[i][0])
    least = {r: min((m for m in ids if m is not None), default=None) for r, ids in members.items()}
    return [(d, len(s), least[root[i]]) for i, ((d, _), s) in enumerate(zip(docs, sets))]


def brute_repeats(docs, length=200):
    data = [(d, (t or "").encode()) for d, t in docs]
    places = defaultdict(int)
    for _, b in data:
        for i in range(len(b) - length + 1):
            places[b[i:i + length]] += 1
    out = []
    for doc_id, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if places[b[i:i + length]] > 1:
                gone[i:i + length] = b"\x01" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
