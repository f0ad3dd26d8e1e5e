"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwarden.detectors.centroid import centroid_distances, detect_centroid
from driftwarden.detectors.envelope import detect_envelope
from driftwarden.detectors.iforest import detect_iforest
from driftwarden.detectors.lof import detect_lof
from driftwarden.detectors.ocsvm import NU, TOLERANCE, detect_ocsvm, optimality
from driftwarden.detectors.vote import majority_vote, stack_flags
from driftwarden.operators import counts as C
from driftwarden.operators import features as X
from driftwarden.operators import metrics as M
from driftwarden.operators import sampling as S
from driftwarden.operators.grids import param_grid
from driftwarden.operators.neighbours import nearest_segments
from driftwarden.operators.ranking import with_position
from driftwarden.operators.segments import genuine, segment_documents, unlabelled
from driftwarden.operators.skew import join_scalars, largest_group
from driftwarden.plans import network as N
from driftwarden.plans import search as R
from driftwarden.plans import spaces as P
from driftwarden.plans import workloads as W
from driftwarden.runtime import cut, deal_scan, scratch_path
from driftwarden.sinks import tables as K
from driftwarden.sources.labels import labelled_segments, read_label_bands
from driftwarden.sources.tokens import read_token_files

# Detector settings scaled to segments of 20 tokens and about 30 segments per stream.
NEIGHBOURS = 5
FOREST = {"trees": 10, "samples": 16, "features": 15}
# The search: candidates per detector, drawn from spaces of the same scale.
DRAWN = 8
THRESHOLDS, SEARCH_NEIGHBOURS = (1.0, 1.3, 25), (2, 12, 6)
SEARCH_FOREST = {"trees": (4, 16, 4), "features": (5, 25, 5), "samples": (4, 12, 5)}
SEARCH_SUPPORT = (0.5, 0.99, 25)
SPLIT_SEED = 7
LONG_TEXT = 2000
NETWORK_EPOCHS = (2, 4, 6, 8)
NETWORK_UNITS = ([4, 4, 4], [6, 6, 6], [8, 8, 8])
KEY = ["entity", "seg"]


def _r(name: str, digits: int = 6):
    return F.round(F.col(name), digits).alias(name)


def _flags(flags: DataFrame) -> DataFrame:
    return flags.select("entity", "seg", _r("score"), "flag")


# --- streams -----------------------------------------------------------------------------------


def read_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    tokens = W.stream_tokens(spark, sf_dir).select("entity", "pos", "token")
    (tokens.repartitionByRange("entity", "pos").sortWithinPartitions("entity", "pos")
     .select("entity", "token").write.partitionBy("entity").text(path))
    return read_token_files(spark, f"{path}/*/*", r"entity=(\d+)/")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.stream_tokens(spark, sf_dir)


def documents_of_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_documents(W.stream_tokens(spark, sf_dir))


def split_genuine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = W.stream_tokens(spark, sf_dir).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_tokens"))
    first = genuine(rows, W.GENUINE).withColumn("part", F.lit("genuine"))
    return first.unionByName(unlabelled(rows, W.GENUINE).withColumn("part", F.lit("unlabelled")))


def vocab_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.count_tokens(W.stream_tokens(spark, sf_dir), KEY)


def vocab_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.count_tokens(W.line_tokens(spark, sf_dir), ["entity"])


def vocab_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.count_tokens(W.line_tokens(spark, sf_dir), [])


def vocab_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.count_levels(W.stream_tokens(spark, sf_dir))


def vocab_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.rank_counts(vocab_entity(spark, sf_dir), ["entity"])


def vocab_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "count_tables")
    levels = cut(C.count_levels(W.stream_tokens(spark, sf_dir)), "levels")
    parts = []
    for level, keys, folders in (("segment", ["entity", "seg"], ["entity"]), ("entity", ["entity"], []), ("total", [], [])):
        ranked = C.rank_counts(levels.filter(F.col("level") == level), keys)
        K.write_count_tables(ranked, f"{root}/{level}", keys, folders)
        inside = [k for k in keys if k not in folders]
        kinds = {"entity": "entity bigint", "seg": "seg int"}
        schema = ", ".join([*[kinds[k] for k in inside], "token string, count bigint", *[kinds[k] for k in folders]])
        back = spark.read.csv(f"{root}/{level}", header=True, schema=schema)
        for key, kind in (("entity", "bigint"), ("seg", "int")):
            if key not in keys:
                back = back.withColumn(key, F.lit(None).cast(kind))
        parts.append(back.select(F.lit(level).alias("level"), "entity", "seg", "token", "count"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def tf_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.stream_features(spark, sf_dir).select("entity", "seg", "term", _r("value"))


# --- detectors ---------------------------------------------------------------------------------


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_distances(W.stream_vectors(spark, sf_dir), ["entity"], "seg").select("entity", "seg", _r("dist"))


def knn_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = nearest_segments(W.stream_vectors(spark, sf_dir), ["entity"], "seg", NEIGHBOURS)
    return near.select("entity", "seg", "rank", "neighbour", "dist")


def centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(detect_centroid(W.stream_vectors(spark, sf_dir)))


def lof(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_lof(W.stream_vectors(spark, sf_dir), k=NEIGHBOURS)


def iforest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """100 trees of up to 100 rows and 60 terms, whatever the length of the streams."""
    return detect_iforest(W.stream_vectors(spark, sf_dir))


def ocsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(detect_ocsvm(W.stream_vectors(spark, sf_dir)))


def ocsvm_nu1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(detect_ocsvm(W.stream_vectors(spark, sf_dir), nu=1.0))


def ocsvm_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = optimality(W.stream_vectors(spark, sf_dir))
    return found.select("entity", "n", _r("total"), (F.col("gap") <= 1.1 * TOLERANCE).alias("optimal"))


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_envelope(W.embedding_vectors(spark, sf_dir), ridge=0.01)


def envelope_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_envelope(W.quantity_vectors(spark, sf_dir))


def _three(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    vectors = W.stream_vectors(spark, sf_dir)
    return {"centroid": detect_centroid(vectors), "lof": detect_lof(vectors, k=NEIGHBOURS),
            "iforest": detect_iforest(vectors, **FOREST)}


def vote_of_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    return majority_vote(stack_flags(_three(spark, sf_dir), KEY), KEY, more_than=1)


def ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = W.stream_vectors(spark, sf_dir)
    flags = {"centroid": detect_centroid(vectors), "lof": detect_lof(vectors, k=NEIGHBOURS),
             "iforest": detect_iforest(vectors, **FOREST), "ocsvm": detect_ocsvm(vectors),
             "envelope": detect_envelope(vectors)}
    return majority_vote(stack_flags(flags, KEY), KEY)


def _five(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None, whole: bool = False) -> dict[str, DataFrame]:
    """Five detectors, the envelope on two columns, where SQL can follow it.

    ``whole`` takes every detector's own settings; else they are scaled down, with the SVM at nu = 1, which has a closed form.
    """
    vectors = W.stream_vectors(spark, sf_dir, lines)
    near, forest, svm = ({}, {}, {}) if whole else ({"k": NEIGHBOURS}, FOREST, {"nu": 1.0})
    return {"centroid": detect_centroid(vectors), "lof": detect_lof(vectors, **near),
            "iforest": detect_iforest(vectors, **forest), "ocsvm": detect_ocsvm(vectors, **svm),
            "envelope": detect_envelope(W.quantity_vectors(spark, sf_dir))}


def vote_of_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return majority_vote(stack_flags(_five(spark, sf_dir, whole=True), KEY), KEY)


# --- labels and evaluation ---------------------------------------------------------------------


def _partial_labels(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Labels as delivered: test cells of entities outside the labelled ones are empty."""
    labels = W.stream_labels(spark, sf_dir, lines)
    known = W.labelled_entities(spark, sf_dir).withColumn("_known", F.lit(1))
    seen = F.col("_known").isNotNull() | (F.col("seg") < W.GENUINE)
    return (join_scalars(labels, known, ["entity"], ["seg"], "left")
            .select("entity", "seg", F.when(seen, F.col("label")).alias("label")))


def _through_matrix(spark: SparkSession, labels: DataFrame) -> DataFrame:
    """Write the matrix in bands, read it back and return the long form of its filled cells."""
    path = scratch_path(spark, "label_matrix")
    K.write_label_bands(labels, path)
    return read_label_bands(spark, path, K.BAND_COLUMNS)


def labels_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_matrix(spark, _partial_labels(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = W.stored_lines(spark, sf_dir)
    docs = segment_documents(W.stream_tokens(spark, sf_dir, lines))
    return labelled_segments(docs, _partial_labels(spark, sf_dir, lines), KEY)


def submission_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = W.stored_lines(spark, sf_dir)
    flags = detect_centroid(W.stream_vectors(spark, sf_dir, lines))
    return _through_matrix(spark, K.fill_labels(_partial_labels(spark, sf_dir, lines), flags, W.GENUINE,
                                                W.labelled_entities(spark, sf_dir)))


def evaluate_detectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of five detectors and their vote against the labels of the labelled entities."""
    lines = W.stored_lines(spark, sf_dir)
    flags = cut(stack_flags(_five(spark, sf_dir, lines), KEY), "flags")
    vote = majority_vote(flags, KEY).select(F.lit("vote").alias("detector"), *KEY, "flag")
    known = W.stream_labels(spark, sf_dir, lines).join(W.labelled_entities(spark, sf_dir), "entity", "left_semi")
    scores = M.evaluate(flags.select("detector", *KEY, "flag").unionByName(vote), known)
    return scores.select("detector", *[_r(c) for c in scores.columns if c != "detector"])


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = W.stored_lines(spark, sf_dir)
    flags = detect_centroid(W.stream_vectors(spark, sf_dir, lines)).withColumnRenamed("flag", "pred")
    return flags.join(W.stream_labels(spark, sf_dir, lines), KEY)


def weighted_grade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.weighted_grade(_judged(spark, sf_dir), ["entity"]).select("entity", _r("grade"))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion_matrix(_judged(spark, sf_dir))


# --- search ------------------------------------------------------------------------------------


def _folds(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """(entity, seg, label, fold) of the labelled entities' test segments."""
    known = W.labelled_entities(spark, sf_dir)
    docs = cut(unlabelled(W.stream_labels(spark, sf_dir, lines), W.GENUINE).join(known, "entity", "left_semi"), "labels")
    return cut(S.stratified_folds(docs, ["entity", "label"], "seg", SPLIT_SEED), "folds")


def _runs(spark: SparkSession, sf_dir: str, lines: DataFrame, folds: DataFrame) -> DataFrame:
    """TF-IDF vectors of the labelled entities' test segments, once per fold of a stratified split."""
    docs = folds.select(*KEY)
    counts = W.stream_features(spark, sf_dir, lines).select(*KEY, "term", "tf").join(docs, KEY, "left_semi")
    counts = cut(counts, "counts")
    idf = X.fit_idf(counts, docs, ["entity"])
    vectors = X.pack_vectors(X.apply_idf(counts, idf, ["entity"], "seg", largest_group(docs, ["entity"])), KEY)
    return cut(R.cross_validated(vectors, folds, KEY), "runs")


def _spaces(names: list[str], whole: bool = False) -> dict[str, dict]:
    """Spaces scaled to the streams at hand; ``whole`` takes the full ones of LOF and the forest."""
    spaces = {"centroid": P.threshold_space(THRESHOLDS), "lof": P.lof_space() if whole else P.lof_space(SEARCH_NEIGHBOURS),
              "iforest": P.iforest_space() if whole else P.iforest_space(**SEARCH_FOREST), "ocsvm": P.ocsvm_space(),
              "envelope": P.envelope_space(SEARCH_SUPPORT)}
    return {n: spaces[n] for n in names}


def _scores(spark: SparkSession, sf_dir: str, whole: bool = False) -> tuple[DataFrame, dict]:
    """Scores and candidates of four detectors; the envelope is searched on two columns, where SQL can follow it.

    ``whole``: 100 candidates a detector, or all there are, from the full spaces.
    """
    lines = W.stored_lines(spark, sf_dir)
    folds = _folds(spark, sf_dir, lines)
    drawn = P.CANDIDATES if whole else DRAWN
    on_terms = R.draw_candidates(spark, _spaces(["centroid", "lof", "iforest"], whole), drawn)
    on_columns = R.draw_candidates(spark, _spaces(["envelope"], whole), drawn)
    columns = cut(R.cross_validated(W.quantity_vectors(spark, sf_dir), folds, KEY), "runs")
    scores = R.search_all(_runs(spark, sf_dir, lines, folds), ["entity"], "seg", on_terms).unionByName(
        R.search_all(columns, ["entity"], "seg", on_columns))
    return scores, on_terms | on_columns


def search_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir, whole=True)[0].select("detector", "entity", "candidate", _r("score"))


def search_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five detectors on the term vectors, the SVM and the envelope in many dimensions among them."""
    lines = W.stored_lines(spark, sf_dir)
    runs = _runs(spark, sf_dir, lines, _folds(spark, sf_dir, lines))
    drawn = R.draw_candidates(spark, _spaces(list(R.TRIALS)), DRAWN)
    return R.search_all(runs, ["entity"], "seg", drawn).select("detector", "entity", "candidate", _r("score"))


def _best(scores: DataFrame) -> DataFrame:
    return R.best_candidates(scores.withColumn("score", F.round("score", 9)))


def search_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(_scores(spark, sf_dir, whole=True)[0])


def _summary(spark: SparkSession, sf_dir: str, cascade: bool) -> DataFrame:
    scores, drawn = _scores(spark, sf_dir)
    params = R.candidate_table(spark, drawn)
    best = cut(_best(scores).join(F.broadcast(params), ["detector", "candidate"]), "best")  # DRAWN rows per detector
    path = scratch_path(spark, "search")
    columns = [*R.PARAMETERS, "score"]
    K.write_search_results(R.result_table(best, columns, cascade=cascade), path)
    back = spark.read.csv(path, header=True, schema=f"row string, {' double, '.join(columns)} double, detector string")
    return back.select("detector", "row", *[_r(c) for c in columns])


def search_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir, False)


def search_summary_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median row counts the mean row in, the deviation row both."""
    return _summary(spark, sf_dir, True)


# --- documents ---------------------------------------------------------------------------------


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.tokenize(W.document_texts(spark, sf_dir), ["entity", "doc_id"])


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.fit_vocabulary(W.document_counts(spark, sf_dir), ["entity"])


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = cut(W.document_counts(spark, sf_dir), "counts")
    largest = largest_group(W.document_rows(spark, sf_dir), ["entity"])
    known = X.known_terms(counts, X.fit_vocabulary(counts, ["entity"]), ["entity"], "doc_id", largest)
    return known.select("entity", "doc_id", "term_id", "term", "tf")


def tfidf_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = cut(W.document_counts(spark, sf_dir), "counts")
    docs = W.document_rows(spark, sf_dir)
    idf = X.fit_idf(counts, docs, ["entity"])
    largest = largest_group(docs, ["entity"])
    return X.apply_idf(counts, idf, ["entity"], "doc_id", largest).select("entity", "doc_id", "term", _r("value"))


def _train_test_features(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """TF-IDF fitted on the training documents, applied to all."""
    counts = cut(X.term_counts(X.tokenize(docs, ["doc_id", "is_train"]), ["doc_id", "is_train"]), "counts")
    idf = X.fit_idf(counts.filter("is_train"), docs.filter("is_train").select("doc_id"), [])
    return X.apply_idf(counts, idf, [], "doc_id", W.document_rows(spark, sf_dir).count())


def tfidf_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = cut(S.train_test_split(W.document_rows(spark, sf_dir).select("doc_id"), "doc_id", SPLIT_SEED), "split")
    docs = deal_scan(W.document_rows(spark, sf_dir).select("doc_id", "text"), "doc_id").join(split, "doc_id")
    return _train_test_features(spark, sf_dir, docs).select("doc_id", "is_train", "term", _r("value"))


def _doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"), "quality")


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = W.table(spark, sf_dir, "documents").select("doc_id")
    return S.train_test_split(docs, "doc_id", SPLIT_SEED)


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stratified_folds(_doc_labels(spark, sf_dir).select("doc_id", "label"), ["label"], "doc_id", SPLIT_SEED)


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.class_weights(_doc_labels(spark, sf_dir), "label").select("label", "n", _r("weight"))


def upsample_minority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.upsample_minority(_doc_labels(spark, sf_dir).select("doc_id", "label"), "label", "doc_id", SPLIT_SEED)


def _scored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents judged by their length: a score and a prediction that need no model."""
    docs = W.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    pred = (F.col("n_chars") >= LONG_TEXT).cast("int").alias("pred")
    return docs.join(_doc_labels(spark, sf_dir), "doc_id").select(
        "doc_id", "lang", "label", "quality", F.col("n_chars").alias("score"), pred)


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = M.binary_metrics(_scored_docs(spark, sf_dir), ["lang"])
    return found.select("lang", *[_r(c) for c in ("accuracy", "precision", "recall", "f1_score")], "tn", "fp", "fn", "tp")


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.roc_auc(_scored_docs(spark, sf_dir), ["lang"]).select("lang", _r("roc_auc"))


def auc_trapezoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality over text length, once in order of length and once in order of the document id."""
    docs = cut(_scored_docs(spark, sf_dir), "scored_docs")
    parts = []
    for order, by in (("length", ["score", "doc_id"]), ("id", ["doc_id"])):
        placed = with_position(docs, ["lang"], by, "pos")
        parts.append(M.auc_trapezoid(placed, ["lang"], "score", "quality", "pos").withColumn("order", F.lit(order)))
    return parts[0].unionByName(parts[1]).select("lang", "order", _r("auc"))


def _network_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(features, rows) of the labelled documents; every term of the training documents is an input."""
    labels = _doc_labels(spark, sf_dir).select("doc_id", "label")
    split = cut(S.train_test_split(labels, "doc_id", SPLIT_SEED), "split")
    docs = W.document_texts(spark, sf_dir).select("doc_id", "text").join(split.drop("label"), "doc_id")
    return cut(_train_test_features(spark, sf_dir, docs).select("doc_id", "term", "value"), "features"), split


def nn_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    features, rows = _network_inputs(spark, sf_dir)
    predicted = N.train_networks(features, rows, "doc_id", [N.Network((16, 8, 0), 0.05, "Adam", (NETWORK_EPOCHS[-1],))])
    return predicted.select("doc_id", "is_train", "label", "pred", _r("score", 3))


def nn_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classifier's grid of 72 points, with narrower layers and fewer epochs than the full space."""
    space = P.classifier_space(epochs=NETWORK_EPOCHS, hidden_units=NETWORK_UNITS)
    grid = [r.asDict() for r in param_grid(spark, space).orderBy("candidate").drop("candidate").collect()]
    features, rows = _network_inputs(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    K.append_metrics(N.grid_metrics(features, rows, "doc_id", grid), path)
    return spark.read.csv(path, header=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_tokens": read_tokens,
    "segments": segments,
    "segment_documents": documents_of_segments,
    "split_genuine": split_genuine,
    "vocab_segment": vocab_segment,
    "vocab_entity": vocab_entity,
    "vocab_total": vocab_total,
    "vocab_levels": vocab_levels,
    "vocab_ranked": vocab_ranked,
    "vocab_csv_roundtrip": vocab_csv_roundtrip,
    "tf_l2": tf_l2,
    "centroid_distances": distances,
    "knn_segments": knn_segments,
    "detect_centroid": centroid,
    "detect_lof": lof,
    "detect_iforest": iforest,
    "detect_ocsvm": ocsvm,
    "detect_ocsvm_nu1": ocsvm_nu1,
    "ocsvm_optimality": ocsvm_optimality,
    "detect_envelope": envelope,
    "detect_envelope_2d": envelope_2d,
    "majority_vote": vote_of_three,
    "majority_vote_of_five": vote_of_five,
    "detect_ensemble": ensemble,
    "labels_unpivot": labels_unpivot,
    "labelled_segments": labelled,
    "submission_matrix": submission_matrix,
    "evaluate_detectors": evaluate_detectors,
    "weighted_grade": weighted_grade,
    "confusion_matrix": confusion_matrix,
    "search_scores": search_scores,
    "search_best": search_best,
    "search_summary": search_summary,
    "search_summary_cascade": search_summary_cascade,
    "search_five": search_five,
    "tokenize": tokenize,
    "vocabulary": vocabulary,
    "term_counts": term_counts,
    "tfidf_l2": tfidf_l2,
    "tfidf_train_test": tfidf_train_test,
    "train_test_split": train_test_split,
    "stratified_folds": stratified_folds,
    "class_weights": class_weights,
    "upsample_minority": upsample_minority,
    "binary_metrics": binary_metrics,
    "roc_auc": roc_auc,
    "auc_trapezoid": auc_trapezoid,
    "nn_classify": nn_classify,
    "nn_metrics": nn_metrics,
}
