"""Secret scan: stated patterns first, then formats learned by grammar inference.

Credentials that the patterns find in the corpus are labelled examples. Those of each kind form a prefix tree over
character classes with counts; states whose futures are statistically compatible (Hoeffding bound) are merged into a
probabilistic automaton. Every other token that mixes letters and digits is a candidate: it is scored by how much
likelier its format is under the best automaton than under ordinary tokens, and reported above a threshold.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwarden.runtime import cut

# fixed values: the stated patterns and the least length of what must match
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
# the same hex runs, found without visiting shorter ones
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
END = "$"


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, value) of the stated patterns, by start, then kind as listed."""
    found = []
    for order, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        for m in (_LONG_HEX if kind == "hex" else pattern).finditer(text):
            if len(m[group]) >= least:
                found.append((m.start(), order, m.end(), kind, m[group]))
    return [(start, kind, end, value) for start, _, end, kind, value in sorted(found)]


def classes(value: str) -> str:
    """One letter per character: digit, lower hex letter, other lower, upper, or the mark itself."""
    out = []
    for ch in value:
        if ch.isdigit():
            out.append("0")
        elif "a" <= ch <= "f":
            out.append("h")
        elif "g" <= ch <= "z":
            out.append("l")
        elif "A" <= ch <= "Z":
            out.append("U")
        else:
            out.append(ch)
    return "".join(out)


class Automaton:
    """Deterministic probabilistic automaton: merged prefix tree with counts."""

    def __init__(self, words: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[Counter] = [Counter()]
        for word in words:
            state = 0
            for ch in word:
                self.count[state][ch] += 1
                if ch not in self.next[state]:
                    self.next[state][ch] = len(self.next)
                    self.next.append({})
                    self.count.append(Counter())
                state = self.next[state][ch]
            self.count[state][END] += 1
        self.width = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.count[a].total(), self.count[b].total()
            if not n or not m:
                continue
            bound = self.width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for ch in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a][ch] / n - self.count[b][ch] / m) > bound:
                    return False
            stack += [(self.next[a][ch], self.next[b][ch]) for ch in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the subtree of b to a."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.count[a] += self.count[b]
            for ch, child in self.next[b].items():
                if ch in self.next[a]:
                    stack.append((self.next[a][ch], child))
                else:
                    self.next[a][ch] = child

    def _merge(self) -> None:
        kept = [0]
        while True:
            border = [(s, ch, t) for s in kept for ch, t in self.next[s].items() if t not in kept]
            if not border:
                break
            state, ch, child = max(border, key=lambda e: (self.count[e[2]].total(), -e[2]))
            for red in kept:
                if self._compatible(red, child):
                    self.next[state][ch] = red
                    self._fold(red, child)
                    break
            else:
                kept.append(child)
        self.states = len(kept)

    def log_likelihood(self, word: str, symbols: int) -> float:
        """Natural log of the probability of ``word``, with add-half smoothing of every state's symbols."""
        state, total = 0, 0.0
        for ch in [*word, END]:
            count = self.count[state] if state is not None else Counter()
            total += math.log((count[ch] + 0.5) / (count.total() + 0.5 * (symbols + 1)))
            state = self.next[state].get(ch) if state is not None else None
        return total


class FormatModel:
    """Automata of the labelled kinds against a class-frequency model of ordinary tokens."""

    def __init__(self, examples: dict[str, list[str]], ordinary: Counter):
        words = {kind: [classes(v) for v in values] for kind, values in examples.items() if values}
        seen = set("0hlU+/_.=-") | {ch for w in words.values() for x in w for ch in x} | set(ordinary)
        self.symbols = len(seen)
        self.automata = {kind: Automaton(w) for kind, w in words.items()}
        total = sum(ordinary.values())
        self.ordinary = {ch: math.log((ordinary[ch] + 1) / (total + self.symbols + 1)) for ch in seen}
        self.other = math.log(1 / (total + self.symbols + 1))

    def score(self, value: str) -> float:
        """Log-likelihood ratio per character of the best automaton over ordinary tokens."""
        if not self.automata:
            return -math.inf
        word = classes(value)
        plain = sum(self.ordinary.get(ch, self.other) for ch in word)
        best = max(a.log_likelihood(word, self.symbols) for a in self.automata.values())
        return (best - plain) / len(word)


def _mixed(value: str) -> bool:
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value)


def learn_formats(docs: DataFrame, examples: int = 400) -> FormatModel:
    """Automata from at most ``examples`` distinct credentials of each kind (those of least hash) of all documents."""

    def collect(frames):
        for frame in frames:
            found = set()
            for text in frame["text"]:
                for _, kind, _, value in base_spans(text or ""):
                    found.add((kind, value))
            marks: Counter = Counter()
            for text in frame["text"]:
                marks.update(text or "")
            ordinary = defaultdict(int)
            for ch, n in marks.items():
                if ch.isascii() and (ch.isalnum() or ch in "+/_.=-"):
                    ordinary[classes(ch)] += n
            yield pd.DataFrame([(k, v, 0) for k, v in found] + [("ordinary", ch, n) for ch, n in ordinary.items()],
                               columns=["kind", "value", "n"])

    values = docs.select("text").mapInPandas(collect, "kind string, value string, n long")
    values = cut(values.groupBy("kind", "value").agg(F.sum("n").alias("n")), "secret-values")
    lists = {}
    for kind in PATTERNS:
        rows = values.where(F.col("kind") == kind).orderBy(F.md5("value"), "value").limit(examples).collect()
        lists[kind] = [r["value"] for r in rows]
    ordinary = Counter({r["value"]: r["n"] for r in values.where("kind = 'ordinary'").collect()})  # ten classes
    return FormatModel(lists, ordinary)


def scan_documents(docs: DataFrame, threshold: float = 1.0) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_format, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start. Null and empty texts have none. Candidates that
    overlap a base span are not scored again. Rows are scanned one by one, repeated or not; without any labelled
    credential no format is known and only base spans are found. An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn_formats(docs))

    def scan(frames):
        for frame in frames:
            out = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                text = text or ""
                base = base_spans(text)
                more, taken = [], [(start, end) for start, _, end, _ in base]
                for m in CANDIDATE.finditer(text):
                    if not _mixed(m[0]) or any(a < m.end() and m.start() < b for a, b in taken):
                        continue
                    if model.value.score(m[0]) >= threshold:
                        more.append((m.start(), "format", m.end()))
                kinds = Counter(kind for _, kind, _, _ in base)
                line = ",".join(f"{kind}:{start}:{end}" for start, kind, end, _ in base)
                both = [(start, i, kind, end) for i, (start, kind, end, _) in enumerate(base)]
                both = sorted(both + [(start, len(base), kind, end) for start, kind, end in more])
                out.append((doc_id, kinds["assign"], kinds["access"], kinds["hex"], len(more),
                            hashlib.sha256(line.encode()).hexdigest(),
                            ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in both)))
            yield pd.DataFrame(out, columns=["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"])

    # ids as text: a null among them would turn the others into floating point
    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        scan, "doc_id string, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
