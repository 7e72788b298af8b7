"""Split sizes, disjointness and independence of the partitioning."""

from pyspark.sql import functions as F

from corpusmill.operators import split as Y


def corpus(spark, n0, n1, parts=8):
    return spark.range(n0 + n1).select(
        F.col("id").alias("doc_id"), (F.col("id") >= n0).cast("int").alias("label")).repartition(parts)


def sizes(df, *by):
    return {tuple(r[:-1]): r[-1] for r in df.groupBy(*by).count().collect()}


def test_published_split_sizes(spark):
    got = sizes(Y.stratified_split(corpus(spark, 17901, 21195)), "split", "label")
    assert got == {("train", 0): 14320, ("train", 1): 16956, ("test", 0): 3581, ("test", 1): 4239}


def test_same_rows_on_any_partitioning(spark):
    def test_side(parts):
        return {r.doc_id for r in Y.stratified_split(corpus(spark, 300, 700, parts)).where("split = 'test'").collect()}
    first = test_side(1)
    assert len(first) == 200 and first == test_side(13)


def test_seed_changes_the_rows(spark):
    def side(seed):
        return {r.doc_id for r in Y.random_split(corpus(spark, 50, 50), seed=seed).where("split = 'test'").collect()}
    assert len(side(1)) == len(side(2)) == 20 and side(1) != side(2)


def test_two_level_ranks_equal_plain_ranks(spark):
    df = corpus(spark, 400, 1600)
    ranked = {r.doc_id: i for i, r in enumerate(
        df.where("label = 1").orderBy(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":42")))).collect())}
    folds = {r.doc_id: r.fold for r in Y.stratified_folds(df).where("label = 1").collect()}
    assert all(folds[d] == i * 5 // 1600 for d, i in ranked.items())


def test_folds_are_even_and_complete(spark):
    got = sizes(Y.stratified_folds(corpus(spark, 103, 251)), "label", "fold")
    for label, n in ((0, 103), (1, 251)):
        counts = [got[(label, f)] for f in range(5)]
        assert sum(counts) == n and max(counts) - min(counts) <= 1


def test_folds_of_the_training_side_are_even(spark):
    split = Y.stratified_split(corpus(spark, 103, 251))
    got = sizes(Y.training_folds(split), "split", "label", "fold")
    for label, n in ((0, 103), (1, 251)):
        counts = [got.get(("train", label, f), 0) for f in range(5)]
        assert max(counts) - min(counts) <= 1 and sum(counts) + got[("test", label, None)] == n


def test_tiny_and_single_class(spark):
    one = Y.stratified_split(corpus(spark, 0, 3))
    assert sizes(one, "split") == {("test",): 1, ("train",): 2}
    assert Y.random_split(corpus(spark, 1, 1)).where("split = 'test'").count() == 0


def test_nested_samples_grow(spark):
    parts = sizes(Y.nested_tenths(corpus(spark, 100, 200)), "part", "label")
    assert all(parts[(p, 0)] == 10 and parts[(p, 1)] == 20 for p in range(1, 11))
