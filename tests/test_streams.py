from pyspark.sql import functions as F

from driftwarden.operators.counts import count_levels, count_tokens, rank_counts
from driftwarden.operators.features import (
    apply_idf, fit_idf, fit_vocabulary, known_terms, l2_normalise, pack_vectors, term_counts, tokenize)
from driftwarden.operators.segments import assign_segments, genuine, outlier_flag, segment_documents, unlabelled
from driftwarden.plans import workloads as W
from driftwarden.plans.queries import QUERIES
from driftwarden.sinks.tables import fill_labels, label_matrix, write_count_tables, write_label_bands, write_label_matrix
from driftwarden.sources.labels import labelled_segments, read_label_bands, read_label_matrix, unpivot_labels
from driftwarden.sources.tokens import read_token_files
from tests.helpers import as_rows


def tokens(spark, words, entity=1):
    return spark.createDataFrame([(entity, i, w) for i, w in enumerate(words)], "entity long, pos long, token string")


def test_segments_and_documents(spark):
    seg = assign_segments(tokens(spark, "a b c d e".split()), 2)
    assert as_rows(segment_documents(seg), "seg", "doc") == [(0, "a b"), (1, "c d"), (2, "e")]
    capped = assign_segments(tokens(spark, "a b c d e".split()), 2, n_segments=1)
    assert as_rows(capped, "token") == [("a",), ("b",)]
    assert genuine(seg, 1).count() == 2 and unlabelled(seg, 1).count() == 3


def test_counts_at_three_levels(spark):
    seg = assign_segments(tokens(spark, "a b a a".split()).unionByName(tokens(spark, ["a"], entity=2)), 2)
    got = {tuple(r) for r in count_levels(seg).select("level", "entity", "seg", "token", "count").collect()}
    assert ("segment", 1, 1, "a", 2) in got and ("entity", 1, None, "a", 3) in got and ("total", None, None, "a", 4) in got
    assert len(got) == 3 + 1 + 2 + 1 + 2
    capped = count_levels(seg, capped_at=1)
    assert capped.filter("level = 'segment' and seg = 1").count() == 0
    assert capped.filter("level = 'entity' and entity = 1 and token = 'a'").first()["count"] == 3


def test_rank_breaks_ties_alphabetically(spark):
    ranked = rank_counts(count_tokens(tokens(spark, "b a c a".split()), ["entity"]), ["entity"])
    assert as_rows(ranked, "rank", "token", "count") == [(1, "a", 2), (2, "b", 1), (3, "c", 1)]


def test_tokenizer(spark):
    docs = spark.createDataFrame([(1, "Dev.post w emacs-20 x_y äöü")], "id long, text string")
    got = [r.term for r in tokenize(docs, ["id"]).orderBy("idx").collect()]
    assert got == ["dev", "post", "emacs", "20", "x_y", "äöü"]


def test_tf_idf_and_unseen_terms(spark):
    docs = spark.createDataFrame([(1, 1, "aa bb"), (1, 2, "aa aa"), (1, 3, "")], "entity long, id long, text string")
    counts = term_counts(tokenize(docs, ["entity", "id"]), ["entity", "id"])
    assert as_rows(fit_vocabulary(counts, ["entity"]), "term", "term_id") == [("aa", 0), ("bb", 1)]
    assert as_rows(fit_vocabulary(counts, ["entity"], max_window_rows=1), "term", "term_id") == [("aa", 0), ("bb", 1)]
    train = fit_idf(counts.filter("id = 2"), docs.filter("id = 2"), ["entity"])
    assert as_rows(apply_idf(counts, train, ["entity"], "id"), "id", "term", "value") == [(1, "aa", 1.0), (2, "aa", 1.0)]
    idf = {r.term: r.idf for r in fit_idf(counts, docs, ["entity"]).collect()}
    assert abs(idf["aa"] - 1.2876820724517808) < 1e-12 and abs(idf["bb"] - 1.6931471805599454) < 1e-12
    voc = fit_vocabulary(counts.filter("id = 2"), ["entity"])
    assert as_rows(known_terms(counts, voc, ["entity"], "id"), "id", "term", "tf") == [(1, "aa", 1), (2, "aa", 2)]
    packed = pack_vectors(l2_normalise(counts, ["entity", "id"], "tf"), ["entity", "id"], docs.select("entity", "id"))
    assert [(r.id, list(r.terms)) for r in packed.orderBy("id").collect()] == [(1, ["aa", "bb"]), (2, ["aa"]), (3, [])]


def test_token_files(spark, tmp_path):
    (tmp_path / "User7").write_text("x\nnull\n\nNA\nx\n")
    (tmp_path / "User12").write_text("a\nb")
    (tmp_path / "notes").write_text("no data\n")
    got = read_token_files(spark, f"{tmp_path}/User*")
    assert as_rows(got, "entity", "pos", "token") == [
        (7, 0, "x"), (7, 1, "null"), (7, 2, "NA"), (7, 3, "x"), (12, 0, "a"), (12, 1, "b")]


def test_line_order_survives_file_splits(spark, tmp_path):
    words = [f"w{i}" for i in range(5000)]
    (tmp_path / "User1").write_text("\n".join(words) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = read_token_files(spark, f"{tmp_path}/User*")
        assert [r.token for r in got.orderBy("pos").collect()] == words
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_count_table_files(spark, tmp_path):
    ranked = rank_counts(count_tokens(tokens(spark, "b a c a".split()), ["entity"]), ["entity"])
    for _ in range(2):
        write_count_tables(ranked, str(tmp_path / "out"), ["entity"], ["entity"])
    files = list((tmp_path / "out" / "entity=1").glob("*.csv"))
    assert [f.read_text() for f in files] == ["token,count\na,2\nb,1\nc,1\n"]


def test_label_matrix_round_trip(spark, tmp_path):
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, None)], "entity long, seg int, label int")
    write_label_matrix(labels, 2, str(tmp_path / "m"))
    back = unpivot_labels(read_label_matrix(spark, str(tmp_path / "m"), 2))
    assert set(map(tuple, back.collect())) == {(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, None)}
    flags = spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "entity long, seg int, flag int")
    known = spark.createDataFrame([(1,)], "entity long")
    assert as_rows(fill_labels(labels, flags, 1, known), "entity", "seg", "label") == [(1, 0, 0), (1, 1, 1), (2, 0, 0), (2, 1, 1)]
    assert label_matrix(labels, 2).columns == ["entity", "0", "1"]
    assert labelled_segments(labels.drop("label"), labels).count() == 3


def test_outlier_flag(spark):
    raw = spark.createDataFrame([(-1,), (1,)], "raw int")
    assert sorted(r[0] for r in raw.select(outlier_flag(F.col("raw"))).collect()) == [0, 1]


def test_label_bands_hold_streams_of_any_length(spark, tmp_path):
    rows = [(1, s, s % 2) for s in range(50_000)] + [(2, 7, 1), (2, 499, None), (2, 500, 0)]
    write_label_bands(spark.createDataFrame(rows, "entity long, seg int, label int"), str(tmp_path / "b"), 500)
    back = read_label_bands(spark, str(tmp_path / "b"), 500)
    assert sorted(map(tuple, back.collect())) == sorted(r for r in rows if r[2] is not None)


def test_genuine_segments_of_unlabelled_entities_are_labelled_segments(spark, tmp_path):
    """Labels of genuine segments are known for every entity, so their segments are returned for every entity."""
    length, known = W.SEGMENT_LENGTH, W.GENUINE
    n = (known + 1) * length
    rows = [(s, s * n + i, 1, i, "N", 1.0, 1.0, 0.0) for s in (1, 2) for i in range(n)]
    spark.createDataFrame(rows, "l_suppkey long, l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, "
                          "l_quantity double, l_extendedprice double, l_discount double").withColumn(
        "l_shipdate", F.timestamp_seconds(F.col("l_orderkey"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "b")], "p_partkey long, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, 9000.0), (2, 0.0)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    got = {(r.entity, r.seg) for r in QUERIES["labelled_segments"](spark, str(tmp_path)).collect()}
    assert got == {(1, s) for s in range(known + 1)} | {(2, s) for s in range(known)}
