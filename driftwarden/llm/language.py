"""Language identification by Bayesian fusion of four kinds of evidence.

Text likelihoods come from byte-trigram models; the declared language, the address suffix and the host add their own
factors. The host factor is a prior smoothed in two steps: a host's counts towards those of its suffix, and a suffix's
towards the whole table. All counts are grouped aggregates over every row. Besides the languages there is a class for
everything else, with a text model, declarations and priors of its own; rows where it wins are rejected.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwarden.llm.common import by_bytes, pack, source_key, unpack
from driftwarden.runtime import cut

LANGUAGES = ("de", "en", "es", "fr")
OTHER = "other"
TABLE = 1 << 15
BATCH_BYTES = 500_000
# a text's trigrams overlap and repeat; beyond this many they add no further certainty
EVIDENCE = 60.0
# a language's share for trigrams it was not seen with lies between these
UNSEEN = (0.02, 0.25)
# log odds by which a text must speak against all languages before the other class is as likely
DOUBT = math.log(1000)
# declarations that name no language, and longer codes of the languages
UNDETERMINED = ("", "mis", "mul", "und", "xx", "zxx")
CODES = {"deu": "de", "ger": "de", "eng": "en", "spa": "es", "fra": "fr", "fre": "fr"}

def _trigrams(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(classes, counts): hashed trigrams of each text's lower-cased letters, and how many each text has."""
    data = [b" " + " ".join(t.lower().split()).encode() + b" " if t and t.strip() else b"" for t in texts]
    lengths = np.array([len(d) for d in data], np.int64)
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.int64)
    letter = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    raw = np.where(letter, raw, 32)
    doc = np.repeat(np.arange(len(data)), lengths)
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(len(data), np.int64)
    inside = (doc[2:] == doc[:-2]) & (letter[:-2] | letter[1:-1] | letter[2:])
    code = raw[:-2] * 65536 + raw[1:-1] * 256 + raw[2:]
    code = (code * 2654435761 >> 12) % TABLE
    return code[inside], np.bincount(doc[2:][inside], minlength=len(data)).astype(np.int64)


def _pieces(texts):
    for a, b in by_bytes([len(t) if t else 0 for t in texts], BATCH_BYTES):
        yield list(texts[a:b])


def train(rows: DataFrame, languages=LANGUAGES) -> np.ndarray:
    """log probabilities, one row per language and a last one for any other text, from all ``rows`` (text, declared)
    with a declaration.

    Each language mixes its trigrams with a uniform share that follows how many of them are new (Witten and Bell).
    Any other text has each trigram with the uniform probability, or half its share in the rows that declare another
    language where that is more. The trigrams of all rows are not its model: they would explain a text that mixes two
    of the languages better than either of them.
    """
    index = {name: i for i, name in enumerate(languages)}

    def count(frames):
        total = np.zeros((len(languages) + 1, TABLE), np.int64)
        for frame in frames:
            frame = frame[frame["declared"].notna()]
            label = frame["declared"].map(lambda x: index.get(x, len(languages))).to_numpy()
            texts = frame["text"].tolist()
            for k in np.unique(label):
                for part in _pieces([t for t, x in zip(texts, label) if x == k]):
                    total[k] += np.bincount(_trigrams(part)[0], minlength=TABLE)
        yield pd.DataFrame({"k": range(len(total)), "counts": [pack(t) for t in total]})

    def add(key, frame):
        return pd.DataFrame({"k": [key[0]], "counts": [pack(sum(unpack(c, np.int64) for c in frame["counts"]))]})

    parts = rows.select("text", "declared").mapInPandas(
        count, "k int, counts binary").groupBy("k").applyInPandas(add, "k int, counts binary").collect()  # a table of fixed size
    total = np.zeros((len(languages) + 1, TABLE))
    for row in parts:
        total[row["k"]] = unpack(row["counts"], np.int64)
    n, kinds = total.sum(1, keepdims=True), (total > 0).sum(1, keepdims=True)
    unseen = np.clip(kinds / np.maximum(n + kinds, 1), *UNSEEN)
    shares = total / np.maximum(n, 1)
    known = (1 - unseen) * shares + unseen / TABLE
    other = np.maximum(shares[len(languages)] / 2, 1 / TABLE)
    return np.log(np.vstack([known[:len(languages)], other]))


def text_evidence(rows: DataFrame, model: np.ndarray) -> Column:
    """Column: array of log-likelihoods per language against the other class, scaled to at most EVIDENCE trigrams,
    and the latter's own, -DOUBT; empty without letters."""
    table = rows.sparkSession.sparkContext.broadcast((model[:-1] - model[-1]).astype(np.float32))

    @F.pandas_udf("array<double>")
    def likelihood(texts: pd.Series) -> pd.Series:
        out = []
        for part in _pieces(texts.tolist()):
            codes, counts = _trigrams(part)
            ends = np.cumsum(counts)
            sums = np.stack([np.diff(np.concatenate(([0.0], np.cumsum(w[codes], dtype=np.float64)))[
                np.concatenate(([0], ends))]) for w in table.value], axis=1)
            scale = np.minimum(1.0, EVIDENCE / np.maximum(counts, 1))
            out += [[*(s * f), -DOUBT] if n else [] for s, f, n in zip(sums, scale, counts)]
        return pd.Series(out)

    return likelihood(F.col("text"))


def _posterior(weights: Column) -> Column:
    """Log weights to probabilities."""
    top = F.array_max(weights)
    parts = F.transform(weights, lambda w: F.exp(w - top))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(parts, lambda p: p / total)


def _sums(column: str, n: int, by: str = "") -> list[Column]:
    return [F.sum(F.round(F.element_at(column, i + 1), 9)).alias(f"{by}{i}") for i in range(n)]


def host_priors(beliefs: DataFrame, n: int, strength: float = 10.0) -> DataFrame:
    """_host, prior: counts of a host smoothed towards its suffix, those of a suffix towards the table.

    ``beliefs`` has _host, _suffix and p, the probabilities from the text alone.
    """
    hosts = cut(beliefs.groupBy("_host", "_suffix").agg(*_sums("p", n, "h")), "host-counts")
    total = hosts.agg(*[F.sum(f"h{i}").alias(f"h{i}") for i in range(n)]).first()
    whole = [float(x or 0.0) + 1.0 for x in total]
    base = [x / sum(whole) for x in whole]
    suffixes = hosts.groupBy("_suffix").agg(*[F.sum(f"h{i}").alias(f"s{i}") for i in range(n)])

    def smooth(counts: list[Column], prior: list) -> list[Column]:
        of = sum(counts[1:], counts[0]) + strength
        return [(c + strength * p) / of for c, p in zip(counts, prior)]

    level = smooth([F.col(f"s{i}") for i in range(n)], [F.lit(b) for b in base])
    suffixes = suffixes.select("_suffix", *[c.alias(f"p{i}") for i, c in enumerate(level)])
    level = smooth([F.col(f"h{i}") for i in range(n)], [F.col(f"p{i}") for i in range(n)])
    # the suffix's own factor: how much likelier it is under a language than in general
    own = [F.log(F.col(f"p{i}") / F.lit(b)) for i, b in enumerate(base)]
    return cut(hosts.join(suffixes, "_suffix").select(
        "_host", "_suffix", F.array(*level).alias("prior"), F.array(*own).alias("suffix_factor")), "host-priors")


def declaration(column: Column) -> Column:
    """The declared language without its region; null if it names none."""
    code = F.lower(F.regexp_extract(column, r"^\s*([A-Za-z]{2,3})(?![A-Za-z])", 1))
    short = F.create_map(*[F.lit(x) for pair in CODES.items() for x in pair])
    # through an array, so that the code is worked out once and not once per use
    return F.get(F.transform(F.array(code), lambda c: F.when(
        ~c.isin(*UNDETERMINED), F.coalesce(F.try_element_at(short, c), c))), F.lit(0))


def identify(rows: DataFrame, keep: list[str], languages=LANGUAGES, trust: float = 0.95,
             least: float = 0.5) -> DataFrame:
    """The ``keep`` columns of ``rows`` plus language, probability and accepted.

    ``rows`` has text, declared, suffix and host. Rows without any letter have no language and are rejected; others
    get the likeliest language or ``OTHER``, and are rejected with the latter or below the probability ``least``. A
    declaration of another language speaks for ``OTHER``, a null one for nothing; null hosts and suffixes share one
    prior each. A language that no row declares is not recognised. Repeated rows count as often as they occur.
    """
    n = len(languages) + 1
    model = train(rows.select("text", declaration(F.col("declared")).alias("declared")), languages)
    scored = rows.withColumns({"_named": declaration(F.col("declared")), "_host": source_key(F.col("host")),
                               "_suffix": source_key(F.col("suffix")), "_ll": text_evidence(rows, model)})
    # read twice: for the priors and for the fusion, without the texts' models running again
    scored = cut(scored.select(*keep, "_named", "_host", "_suffix", "_ll"), "language-evidence")
    beliefs = scored.where(F.size("_ll") > 0).select("_host", "_suffix", _posterior(F.col("_ll")).alias("p"))
    priors = host_priors(beliefs, n)
    named = F.when(F.col("_named").isin(list(languages)), F.col("_named")).otherwise(OTHER)
    said = F.array(*[
        F.when(F.col("_named").isNull(), 0.0).when(named == name, math.log(trust)).otherwise(
            math.log((1 - trust) / (n - 1))) for name in (*languages, OTHER)])
    joined = scored.withColumn("_said", said).join(priors, ["_host", "_suffix"], "left")
    weights = F.transform(F.col("_ll"), lambda w, i: w + F.get("_said", i) + F.log(F.get("prior", i))
                          + F.get("suffix_factor", i))
    joined = joined.withColumn("_p", F.when((F.size("_ll") > 0) & F.col("prior").isNotNull(), _posterior(weights)))
    best = F.array_max("_p")
    joined = joined.withColumn("probability", F.round(best, 6))
    names = F.array(*[F.lit(x) for x in (*languages, OTHER)])
    language = F.when(best.isNotNull(), F.element_at(names, F.array_position("_p", best).cast("int")))
    return joined.select(*keep, language.alias("language"), "probability",
                         F.coalesce((F.col("probability") >= least) & (language != OTHER), F.lit(False)).alias("accepted"))


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, text (tags, scripts and entities taken out), declared, suffix, host of raw pages.

    The declaration is looked for in the whole page, comments and scripts taken out.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(bare, r"<[^>]*>|&#?\w+;", " ")
    declared = F.lower(F.regexp_extract(bare, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z]{2,3})""", 1))
    host = F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1))
    return pages.select("page_id", text.alias("text"), F.nullif(declared, F.lit("")).alias("declared"),
                        F.nullif(F.regexp_extract(host, r"\.([a-z]+)(?::\d+)?$", 1), F.lit("")).alias("suffix"),
                        F.nullif(host, F.lit("")).alias("host"))


def identify_pages(pages: DataFrame) -> DataFrame:
    """page_id, language, probability, accepted, declared and host of every page."""
    return identify(page_rows(pages), ["page_id", "declared", "host"])


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents (all columns) whose language is accepted; the source stands for the host, lang is the
    declaration. Documents have no address, so the suffix is empty."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "text", F.lower("lang").alias("declared"),
                       F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))
    return identify(rows, ["row"]).where("accepted").select("row.*")
