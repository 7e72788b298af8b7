"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusmill.llm.common import broadcast_measured, materialize

BUCKETS = 4096     # of ranks, per source; only the one that holds the cut is sorted
WORD_GAPS = r"[\x20\x09-\x0D]+"


def count_words(text: str) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), WORD_GAPS), "")).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, take the weights in turn and share
    ``share`` x the total by them. A target stops at ``cap`` x its source; the
    excess goes to the others by weight until none is above. With sources in
    the order of cap / weight, the level is found from running sums.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.lit(cap) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    onward = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    found = ranked.withColumn("level", level).withColumn(
        "fair", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(every))
    return found.select("source", "source_size", F.least("most", F.col("weight") * F.col("fair")).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
                seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) per row: how many words of each text the mix takes.

    A document of a source is wanted ``c = min(cap, k x interest)`` times,
    where interest is the bit length of its size (longer texts are preferred
    mildly) and ``k`` makes the words of the source come to its target. The
    whole part of ``c`` is certain: ``copies`` full copies. The fraction is an
    inclusion probability p: documents are ranked by the odds of a random
    number, drawn from the id, divided by the odds of p (Pareto order
    sampling), and taken in that order until the source's remaining words are
    used up. The sample is fixed-size in words: of the document at the cut
    only as many words are taken as the target still holds, so each source
    meets its target to the word.

    The order of a source is never sorted as a whole: rows are summed by rank
    bucket, the bucket with the cut is found on that table, and only its rows
    are sorted. Texts are read once and not shuffled; rows carry sizes. Null
    and blank texts have size 0 and give nothing; a null source is a source of
    its own, the last; ties in rank go by id, then size; repeated rows share
    one rank and may be taken in part; no rows give no rows; other columns are ignored.
    """
    sized = materialize(docs.select("doc_id", "source", count_words("text").alias("size")).withColumn(
        "interest", F.length(F.bin("size")).cast("bigint")).withColumn("interest", F.when(F.col("size") > 0, F.col("interest")).otherwise(0)), "sized")
    classes = materialize(sized.groupBy("source", "interest").agg(F.sum("size").alias("words")), "interest-classes")
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, cap)
    longest = Window.partitionBy("source").orderBy(F.col("interest").desc())
    joined = classes.alias("c").join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source"))).select("t.*", "interest", "words")
    k = ((F.col("target") - F.lit(cap) * F.coalesce(F.sum("words").over(longest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         / F.sum(F.col("words") * F.col("interest")).over(longest.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    plan = joined.withColumn("k", F.when(F.col("words") > 0, k)).withColumn("k", F.max(F.when(
        F.col("k") * F.col("interest") <= cap, F.col("k"))).over(Window.partitionBy("source")))
    plan = plan.withColumn("wanted", F.least(F.lit(cap), F.coalesce(F.col("k") * F.col("interest"), F.lit(cap))))
    plan = plan.withColumn("copies", F.floor("wanted")).withColumn(
        "left", F.round("target").cast("bigint") - F.sum(F.col("copies") * F.col("words")).over(Window.partitionBy("source")))
    plan = materialize(plan.select("source", "interest", "source_size", "target", "wanted", "copies", "left"), "mix-plan")

    same = [F.col("d.source").eqNullSafe(F.col("p.source")), F.col("d.interest") == F.col("p.interest")]
    p = F.col("wanted") - F.col("copies")
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10)
         .cast("bigint") + 0.5) / float(1 << 52)
    rank = F.when((p > 0) & (F.col("size") > 0), (u / (1 - u)) / (p / (1 - p)))
    rows = (sized.alias("d").join(broadcast_measured(plan, 128).alias("p"), same)
            .select("d.doc_id", "p.source", "d.size", "source_size", "target", "copies", "left", rank.alias("rank"))
            .withColumn("bucket", F.floor(F.col("rank") / (1 + F.col("rank")) * BUCKETS)))
    sums = rows.where("bucket IS NOT NULL").groupBy("source", "left", "bucket").agg(F.sum("size").alias("words"))
    cum = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    cuts = sums.withColumn("reached", cum).where(F.col("reached") >= F.col("left")).groupBy("source").agg(
        F.min("bucket").alias("cut"), F.min_by(F.col("left") - (F.col("reached") - F.col("words")), "bucket").alias("room"))
    cuts = materialize(cuts, "mix-cuts")
    rows = rows.alias("r").join(broadcast_measured(cuts, 96).alias("x"), F.col("r.source").eqNullSafe(F.col("x.source")), "left").select("r.*", "cut", "room")
    at_cut = rows.where("bucket = cut")
    ahead = F.coalesce(F.sum("size").over(Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sampled = at_cut.withColumn("extra", F.greatest(F.lit(0), F.least("size", F.col("room") - ahead))).unionByName(
        rows.where("bucket IS NULL OR cut IS NULL OR bucket <> cut").withColumn(
            "extra", F.when(F.col("bucket") < F.coalesce("cut", F.lit(BUCKETS)), F.col("size")).otherwise(0)))
    return sampled.select("doc_id", "source", "size", "source_size", "target", "copies",
                          (F.col("copies") * F.col("size") + F.col("extra")).cast("bigint").alias("taken"))


MIX_SQL = r"""
WITH sized AS (SELECT doc_id, source, size, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS interest FROM (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents)),
 sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
 ranked AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS most FROM sources),
 levels AS (SELECT *, most / weight AS ratio, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER before, 0)) / sum(weight) OVER onward AS level FROM ranked
        WINDOW before AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               onward AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 targets AS (SELECT source, source_size, least(most, weight * max(level) FILTER (level <= ratio) OVER ()) AS target FROM levels),
 classes AS (SELECT source, interest, sum(size)::BIGINT AS words FROM sized GROUP BY source, interest),
 ks AS (SELECT t.*, interest, words, CASE WHEN words > 0 THEN (target - 2.0::DOUBLE * coalesce(sum(words) OVER before, 0)) / sum(words * interest) OVER onward END AS k
        FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
        WINDOW before AS (PARTITION BY t.source ORDER BY interest DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
               onward AS (PARTITION BY t.source ORDER BY interest DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 wanted AS (SELECT source, interest, source_size, target, words, least(2.0::DOUBLE, coalesce(
        max(k) FILTER (k * interest <= 2.0::DOUBLE) OVER (PARTITION BY source) * interest, 2.0::DOUBLE)) AS wanted FROM ks),
 plan AS (SELECT *, floor(wanted)::BIGINT AS copies, round(target)::BIGINT - sum(floor(wanted)::BIGINT * words) OVER (PARTITION BY source) AS room FROM wanted),
 odds AS (SELECT doc_id, s.source, size, source_size, target, copies, room, wanted - copies AS p,
        (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
        FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source AND s.interest = p.interest),
 ordered AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM odds),
 filled AS (SELECT *, coalesce(sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM ordered)
SELECT doc_id, size, source_size, target,
    (copies * size + CASE WHEN rank IS NULL THEN 0 ELSE greatest(0, least(size, room - ahead)) END)::BIGINT AS taken FROM filled"""
