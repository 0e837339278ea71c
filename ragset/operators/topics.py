"""Topics and their words, rank and score replies, fused vectors, boxes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragset.functions.text import l2_normalize

#: English function words left out of vocabularies; a fixed list.
STOP = "a about after all also an and any are as at be been but by can could for from had has have he her his if in into is it its more no not of on or our she so some than that the their them then there these they this to was we were what when which who will with would you your".split()


def ngram_vocabulary(docs: DataFrame, written, min_df: int = 2, stop: list[str] = STOP) -> DataFrame:
    """(gram, df): words and pairs of neighbouring words, those of stop removed, of at least min_df documents."""
    kept = docs.select("doc_id", F.filter("words", lambda w: ~w.isin(list(stop))).alias("w"))
    pairs = F.when(F.size("w") > 1, F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    return kept.select(F.explode(F.array_distinct(F.concat("w", pairs))).alias("gram")).groupBy("gram").agg(F.count("*").alias("df")).where(F.col("df") >= min_df)


def topic_keywords(docs: DataFrame, k: int) -> DataFrame:
    """(topic, word, weight, rank): share of the topic's words times ln(1 + mean words a topic / the word's count)."""
    tf = docs.select("topic", F.explode("words").alias("word")).groupBy("topic", "word").agg(F.count("*").alias("tf"))
    # one row a topic; the sums over words come from the same shuffled counts
    topics = tf.groupBy("topic").agg(F.sum("tf").alias("n")).withColumn("mean", F.sum("n").over(Window.partitionBy()) / F.count("*").over(Window.partitionBy()))
    f = F.sum("tf").over(Window.partitionBy("word"))
    w = tf.withColumn("f", f).join(topics, "topic").select("topic", "word", (F.col("tf") / F.col("n") * F.log(1 + F.col("mean") / F.col("f"))).alias("weight"))
    return w.withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc(F.round("weight", 12)), "word"))).where(F.col("rank") <= k)


def letter_pairs(word: Column, dims: int = 64) -> Column:
    """A plain vector of a word: counts of its pairs of neighbouring letters in dims buckets, of unit length."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(word) - 1)), lambda i: F.pmod(F.ascii(F.substring(word, i, F.lit(1))) * 31 + F.ascii(F.substring(word, i + 1, F.lit(1))), F.lit(dims)))
    counted = F.transform(F.array(pairs), lambda b: F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: F.size(F.filter(b, lambda x: x == i)).cast("double")))
    return l2_normalize(F.element_at(counted, 1))


def diversify_keywords(keywords: DataFrame, k: int, diversity: float = 0.5) -> DataFrame:
    """(topic, word, rank): maximal marginal relevance over each topic's few candidates (topic, word, weight, rank, v).

    Again and again the candidate of the highest (1 - diversity) * weight, as a share of the topic's largest, less diversity times
    its largest cosine with a chosen one (v of unit length); the better rank on ties. A fold over the topic's array.
    """
    near = lambda v, w: F.aggregate(F.zip_with(v, w, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def fold(c: Column) -> Column:
        def best(chosen: Column) -> Column:
            most = lambda e: F.coalesce(F.array_max(F.transform(chosen, lambda j: near(e["v"], F.get(c, j)["v"]))), F.lit(0.0))
            score = lambda e: F.round((1 - diversity) * e["share"] - diversity * most(e), 9)
            return F.array_max(F.transform(c, lambda e, p: F.when(~F.array_contains(chosen, p), F.struct(score(e).alias("score"), (-p).alias("p")))))["p"]

        none = F.array().cast("array<int>")
        chosen = F.aggregate(F.sequence(F.lit(1), F.least(F.lit(k), F.size(c))), none, lambda done, _: F.concat(done, F.array(-best(done))))
        return F.transform(chosen, lambda j: F.get(c, j)["word"])

    share = F.col("weight") / F.greatest(F.max("weight").over(Window.partitionBy("topic")), F.lit(1e-12))
    own = keywords.withColumn("share", share).groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "share", "v"))).alias("c"))
    picked = own.select("topic", F.posexplode(F.transform(F.array("c"), fold)[0]).alias("rank", "word"))
    return picked.select("topic", "word", (F.col("rank") + 1).cast("long").alias("rank"))


def topic_summary(docs: DataFrame, keywords: DataFrame, most: int = 15) -> DataFrame:
    """Topics by size with their share of all and their keywords joined; topic -1 counts in the total alone."""
    total = docs.agg(F.count("*").alias("total"))
    words = keywords.groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"]), ", ").alias("keywords"))
    n = docs.groupBy("topic").agg(F.count("*").alias("n")).where(F.col("topic").cast("string") != "-1")
    return n.crossJoin(total).join(words, "topic", "left").select("topic", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"), "keywords").orderBy(F.desc("n"), "topic").limit(most)


def assign_topics(vectors: DataFrame, k: int, written, dims: int = 5, seed: int = 42, outliers: float | None = None) -> DataFrame:
    """Principal components, then seeded k-means; rows with topic and far, the distance to their topic's centre.

    With outliers, rows further from their centre than that share of its topic's rows (by a mergeable quantile sketch) have topic -1.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = written(vectors).withColumn("features", array_to_vector("v"))
    low = PCA(k=dims, inputCol="features", outputCol="low").fit(v).transform(v)
    model = KMeans(k=k, seed=seed, featuresCol="low", predictionCol="topic").fit(low)
    centres = F.array(*[F.array(*map(F.lit, map(float, c))) for c in model.clusterCenters()])
    gap = F.zip_with(vector_to_array("low"), F.get(centres, F.col("topic")), lambda a, b: (a - b) * (a - b))
    out = model.transform(low).withColumn("far", F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x)))
    if outliers is None:
        return out
    out = written(out.drop("features", "low"))
    edge = out.groupBy("topic").agg(F.percentile_approx("far", outliers, 10_000).alias("edge"))
    return out.join(edge, "topic").withColumn("topic", F.when(F.col("far") > F.col("edge"), -1).otherwise(F.col("topic"))).drop("edge")


def parse_rankings(replies: DataFrame, key: str, reply: str, candidates: Column) -> DataFrame:
    """(key, chunk, score): 1 - (rank - 1) / candidates, the first mention counts, chunks without one score 0."""
    found = lambda g: F.regexp_extract_all(F.col(reply), F.lit(r"<Rank ([0-9]+)>Chunk ([0-9]+)"), F.lit(g))
    said = replies.select(key, F.posexplode(F.arrays_zip(found(1).alias("r"), found(2).alias("c"))).alias("pos", "x"))
    first = said.select(key, "pos", F.col("x.r").cast("int").alias("r"), F.col("x.c").cast("int").alias("chunk"))
    first = first.withColumn("no", F.row_number().over(Window.partitionBy(key, "chunk").orderBy("pos"))).where("no = 1")
    every = replies.select(key, F.size(candidates).alias("n"), F.explode(candidates).alias("chunk"))
    return every.join(first.select(key, "chunk", "r"), [key, "chunk"], "left").select(key, "chunk", F.coalesce(1 - (F.col("r") - 1) / F.col("n"), F.lit(0.0)).alias("score"))


def parse_score(reply: Column) -> Column:
    """The number that the reply is or holds, within 0 and 1; 0.5 without one."""
    inside = F.regexp_extract(reply, r"([0-9]+(?:\.[0-9]+)?)", 1)
    n = F.coalesce(F.trim(reply).try_cast("double"), F.when(inside != "", inside).try_cast("double"))
    return F.when(n.isNull(), 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), n)))


def fuse_vectors(text: str, image: str) -> Column:
    """The normalised mean of both normalised vectors; the text's alone where there is no image."""
    a, b = l2_normalize(text), l2_normalize(image)
    return l2_normalize(F.when(F.col(image).isNull(), a).otherwise(F.zip_with(a, b, lambda x, y: (x + y) / 2)))


def pictures_in_tables(pictures: DataFrame, tables: DataFrame, cell: float = 100.0, page: tuple[str, ...] = ("doc", "page_no")) -> DataFrame:
    """Pictures inside a table box of their page (l, r, b, t, and the columns page).

    A table stands in every cell of a grid that it covers, a picture in the one of its lower left corner, so that the boxes
    of a crowded page meet cell by cell. A box with a null side lies in none.
    """
    at = lambda c: F.floor(F.col(c) / cell).cast("long")
    whole = tables.where("l <= r and b <= t")
    over = whole.withColumn("x", F.explode(F.sequence(at("l"), at("r")))).withColumn("y", F.explode(F.sequence(at("b"), at("t")))).select(*page, "x", "y", *(F.col(c).alias(f"o{c}") for c in "lrbt"))
    placed = pictures.withColumns({"x": at("l"), "y": at("b")})
    inside = [placed[c] == over[c] for c in (*page, "x", "y")] + [placed["l"] >= over["ol"], placed["r"] <= over["or"], placed["b"] >= over["ob"], placed["t"] <= over["ot"]]
    return placed.join(over, inside, "left_semi").drop("x", "y")
