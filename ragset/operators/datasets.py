"""Datasets of questions: gates to outcomes, targets, corrections, prompts, caches, progress, results and their statistics."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragset.functions.text import is_missing, token_estimate
from ragset.operators.chunking import image_refs
from ragset.operators.replies import parse_packs, verified
from ragset.operators.seams import respond
from ragset.sources.shared import written


def numbered(items: Column, what: str = "Chunk", rule: str = "\n---\n") -> Column:
    """An array of texts as numbered blocks joined by a rule."""
    return F.array_join(F.transform(items, lambda x, i: F.concat(F.lit(f"{what} "), (i + 1).cast("string"), F.lit(": "), x)), rule)


def build_prompt(template: str, **fields: Column) -> Column:
    """The template with each {name} replaced by its column; a null is an empty text."""
    parts = re.split(r"\{(\w+)\}", template)  # texts and names by turns, so that a column's own braces stay
    return F.concat(*[F.coalesce(fields[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def seeded_order(*keys: str, seed: int = 42) -> Column:
    """A key whose order is a shuffle fixed by the seed."""
    return F.md5(F.concat(F.lit(str(seed)), F.concat_ws("|", *[F.col(k).cast("string") for k in keys])).cast("binary"))


def take_target(rows: DataFrame, kinds: str, wanted: str, target: int, *order: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(taken, set aside, stats): the first `target` rows in order whose kinds hold `wanted`; those of other kinds with a failure_reason; one row of stats.

    corpus_exhausted is set where there are fewer matching rows than the target; chunk_budget is 1.1 times the target, rounded up.
    """
    fits = F.coalesce(F.array_contains(kinds, wanted), F.lit(False))
    taken = rows.where(fits).orderBy(*order).limit(target)
    aside = rows.where(~fits).withColumn("failure_reason", F.lit(f"Does not match target type '{wanted}'"))
    n = F.least(F.count_if(fits), F.lit(target))
    stats = rows.agg(n.cast("long").alias("generated"), (n >= target).alias("target_reached"), (n < target).alias("corpus_exhausted"), F.count_if(~fits).alias("mismatched"))
    return taken, aside, stats.withColumn("chunk_budget", F.lit(math.ceil(11 * target / 10)).cast("long"))


def generate_to_target(
    chunks: DataFrame, request: Column, generate: Callable[[str], str], kinds: Callable[[DataFrame], Column], wanted: str, target: int, *keys: str, seed: int = 42, surplus: float = 1.1, written=written
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(taken, set aside, stats): pairs generated from chunks in the seed's order until `target` of them have the wanted kind,
    or ceil(surplus * target) chunks have been asked.

    Chunks are asked by ranges of the seed's hash, each about as large as the rows still missing ask for at the yield so
    far; what lies beyond the last range is never asked. keys name a chunk; request is a column of chunks, kinds gives
    the column of a pair's kinds. taken and set aside (with a failure_reason) have the chunk's columns, pack, question,
    answer. stats: chunks, requests (chunks asked), generated, target_reached, corpus_exhausted, mismatched, chunk_budget.
    """
    budget = -(-round(surplus * 1000) * target // 1000)
    placed = written(chunks.withColumns({"_order": seeded_order(*keys, seed=seed), "_request": request}))
    total = placed.count()
    share = F.conv(F.substring("_order", 1, 8), 16, 10).cast("double") / 2.0**32
    low, asked, found, pairs = 0.0, 0, 0, None
    while low < 1.0 and found < target and asked < budget and total:
        rate = max(found / asked, 0.05) if asked else 1.0
        want = min(budget - asked, max(1, math.ceil((target - found) / rate)))
        high = min(1.0, low + 1.05 * want / total + 1e-9)
        some = placed.where((share >= low) & (share < high) if high < 1.0 else share >= low)
        # a range holds some more or fewer chunks than asked for; those over the budget go
        some = written(some.orderBy("_order", *keys).limit(budget - asked))
        replies = some.join(respond(some.select(F.col("_request").alias("request")), generate, written).withColumnRenamed("request", "_request"), "_request")
        got = parse_packs(replies).drop("reorganized", "_request")
        got = written(got.withColumn("_fits", F.coalesce(F.array_contains(kinds(got), wanted), F.lit(False))))
        pairs = got if pairs is None else pairs.unionByName(got)
        asked, found, low = asked + some.count(), found + got.where("_fits").count(), high
    if pairs is None:
        pairs = chunks.limit(0).select("*", F.lit("").alias("_order"), F.lit(0).alias("pack"), F.lit("").alias("question"), F.lit("").alias("answer"), F.lit(False).alias("_fits"))
    taken = pairs.where("_fits").orderBy("_order", *keys, "pack").limit(target).drop("_fits", "_order")
    aside = pairs.where("not _fits").drop("_fits", "_order").withColumn("failure_reason", F.lit(f"Does not match target type '{wanted}'"))
    n = min(found, target)
    stats = chunks.sparkSession.range(1).select(*(F.lit(v).cast(t).alias(k) for k, v, t in (("chunks", total, "long"), ("requests", asked, "long"), ("generated", n, "long"), ("target_reached", n >= target, "boolean"), ("corpus_exhausted", n < target and asked >= min(budget, total), "boolean"), ("chunk_budget", budget, "long"))))
    return taken, aside, stats.crossJoin(aside.agg(F.count("*").alias("mismatched")))  # one row each


#: The texts asked for a correction and a verification, where no other is given.
CORRECT = "Question: {question}\nAnswer: {answer}\nFeedback: {verification}"
VERIFY = "Question: {question}\nAnswer: {answer}"


def correction_rounds(failed: DataFrame, correct: Callable[[str], str], verify: Callable[[str], str], written, attempts: int = 1) -> tuple[DataFrame, DataFrame]:
    """(passed, failed): failed pairs (id, question, answer, verification and, where known, has_image) are asked for again with their verification as feedback, parsed and verified, up to `attempts` times.

    has_image says whether the pair's chunks hold an image (false where it is absent): a pair that cites a figure passes only with one.
    Passed pairs are CORRECTED and carry their attempt. Pairs that still fail, and those whose correction gave no pair, carry
    a failure_reason. A correction may give several pairs for one id. Each round's replies are written before use.
    """
    texts = {c: F.col(c) for c in ("question", "answer", "verification")}
    verdict = build_prompt(VERIFY, question=texts["question"], answer=texts["answer"])
    image = F.coalesce(F.col("has_image"), F.lit(False)) if "has_image" in failed.columns else F.lit(False)
    seen = failed.select("id", image.alias("has_image")).groupBy("id").agg(F.max("has_image").alias("has_image"))
    now, passed, lost = failed.select("id", "question", "answer", "verification"), None, None
    for turn in range(1, attempts + 1):
        asked = written(now.withColumn("request", build_prompt(CORRECT, **texts)))
        replies = asked.join(respond(asked, correct, written), "request", "left").select("id", "reply")
        pairs = written(parse_packs(replies).select("id", "pack", "question", "answer").withColumn("request", verdict))
        judged = written(pairs.join(respond(pairs, verify, written), "request", "left").join(seen, "id").select("id", "pack", "question", "answer", F.col("reply").alias("verification"), "has_image"))
        ok = verified(F.col("verification"), F.col("question"), F.col("answer"), F.col("has_image"))
        good = judged.where(ok).drop("has_image").withColumns({"selection_status": F.lit("CORRECTED"), "correction_attempt": F.lit(turn)})
        # fixed values: the reasons of a failure
        none = asked.join(judged.select("id").distinct(), "id", "left_anti").select("id", "question", "answer", "verification", F.lit("Correction produced no valid pairs").alias("failure_reason"))
        passed = good if passed is None else passed.unionByName(good)
        lost = none if lost is None else lost.unionByName(none)
        now = judged.where(~ok).select("id", "question", "answer", "verification")
    rest = now.withColumn("failure_reason", F.lit(f"Failed verification after {attempts} correction attempt(s)"))
    return passed, rest.unionByName(lost)


def outcome_of(status: Column) -> Column:
    """pass, malformed or fail of a gate's status."""
    return F.when(status == "SELECTED", "pass").when(status == "ERROR", "malformed").otherwise("fail")


def write_outcomes(rows: DataFrame, outcome: str, path: str, contexts: DataFrame | None = None) -> None:
    """Rows as Parquet by outcome, a folder an outcome, and contexts (the chunks that rows rest on) in a folder of its own, each written whole or not at all by Spark's committer."""
    rows.write.partitionBy(outcome).parquet(f"{path}/rows")
    if contexts is not None:
        contexts.write.parquet(f"{path}/contexts")


def outcome_stats(rows: DataFrame, outcome: str, n_chunks: str) -> DataFrame:
    """One row: malformed, failed and passed rows, passed ones of one and of several chunks, and the share that passed."""
    is_ = lambda v: F.col(outcome) == v
    return rows.agg(
        F.count_if(is_("malformed")).alias("malformed"), F.count_if(is_("fail")).alias("failed"), F.count_if(is_("pass")).alias("passed"),
        F.count_if(is_("pass") & (F.col(n_chunks) > 1)).alias("multi_chunk"), F.count_if(is_("pass") & (F.col(n_chunks) <= 1)).alias("single_chunk"), F.try_divide(F.count_if(is_("pass")), F.count("*")).alias("success_rate"),
    )


def filter_chunks_by_type(chunks: DataFrame, qa_type: str, artifact: str = "artifact") -> DataFrame:
    """The chunks that questions of a type start from: those with an artifact for multimodal, without one for text, else all."""
    if qa_type == "multimodal":
        return chunks.where(~is_missing(F.col(artifact)))
    return chunks.where(is_missing(F.col(artifact))) if qa_type == "text" else chunks


def cache_key(kind: str, model: str, prompt: Column, chunks: Column | None = None) -> Column:
    """kind, model and the first 32 hex digits of the hashes of the prompt and of the chunks' JSON ('none' without chunks)."""
    short = lambda c: F.substring(F.sha2(c, 256), 1, 32)
    some = F.lit("none") if chunks is None else F.coalesce(F.when(F.size(chunks) > 0, short(F.to_json(chunks))), F.lit("none"))
    return F.concat(F.lit(f"{kind}_{model}_"), short(F.coalesce(prompt, F.lit(""))), F.lit("_"), some)


def cache_lookup(requests: DataFrame, cache: DataFrame, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """(requests with response, distinct missing keys); a miss's response is null."""
    r = requests.join(cache.select(key, "response"), key, "left")
    return r, r.where("response is null").select(key).distinct()


def cache_stats(looked: DataFrame, prompt: str) -> DataFrame:
    """One row of looked-up requests: hits, misses, the hit rate in percent and the tokens saved, a quarter of the characters."""
    hit = F.col("response").isNotNull()
    return looked.agg(F.count_if(hit).alias("hits"), F.count_if(~hit).alias("misses"), F.coalesce(F.try_divide(100.0 * F.count_if(hit), F.count("*")), F.lit(0.0)).alias("hit_rate"), F.coalesce(F.sum(F.when(hit, F.floor(F.length(prompt) / 4))), F.lit(0)).alias("tokens_saved"))


def cache_upsert(cache: DataFrame, new: DataFrame, key: str = "cache_key", version: str = "version") -> DataFrame:
    """The newest response of each key (by version, then the lower text); empty ones are not stored."""
    both = cache.unionByName(new).where("response <> ''")
    w = Window.partitionBy(key).orderBy(F.desc(version), "response")
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


#: Keys that are sent to all tasks at once, in a look-up; more are joined by a shuffle.
SENT = 200_000


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _stored(spark, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def cache_store(new: DataFrame, path: str, key: str = "cache_key", version: str = "version", buckets: int = 256) -> int:
    """cache_upsert() of new into the table at path, which lies in buckets of its keys' hash; the number of buckets that were touched.

    Only the touched buckets are read and written; the others keep their files. What they will hold is written aside first, so
    that a repeated write finds it. The number of buckets must stay the same for a path; one writer at a time.
    """
    added = written(cache_upsert(new.limit(0), new, key, version).withColumn("bucket", _bucket(key, buckets)))
    touched = [r.bucket for r in added.select("bucket").distinct().collect()]  # at most buckets numbers
    if touched:
        old = _stored(new.sparkSession, path, added.schema)
        old = added.limit(0) if old is None else old.where(F.col("bucket").isin(touched)).select(added.columns)
        after = written(cache_upsert(old, added, key, version))
        after.repartition(len(touched), "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return len(touched)


def cache_find(requests: DataFrame, path: str, schema: str, key: str = "cache_key", buckets: int = 256, sent: int = SENT) -> tuple[DataFrame, DataFrame]:
    """cache_lookup() in the table of cache_store() at path, whose columns are schema: only the buckets of the requests' keys are read.

    Up to `sent` distinct keys go to the tasks that scan the cache, so that only what they find is shuffled.
    """
    keys = written(requests.select(key).distinct().withColumn("bucket", _bucket(key, buckets)))
    touched = [r.bucket for r in keys.select("bucket").distinct().collect()]
    cache = _stored(requests.sparkSession, path, f"{schema}, bucket int")
    if cache is None:
        return requests.withColumn("response", F.lit(None).cast("string")), keys.select(key)
    cache = cache.where(F.col("bucket").isin(touched)).drop("bucket")
    if keys.count() <= sent:
        cache = cache.join(F.broadcast(keys.select(key)), key, "left_semi")
    return cache_lookup(requests, cache, key)


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return items.join(done.select(key), key, "left_anti")


def progress_summary(rows: DataFrame, stage: str, status: str, at: str) -> DataFrame:
    """By stage: completed and failed items and the last update."""
    return rows.groupBy(stage).agg(F.count_if(F.col(status) == "COMPLETE").alias("completed"), F.count_if(F.col(status) == "INCOMPLETE").alias("failed"), F.max(at).alias("last"))


def token_usage(calls: DataFrame, model: str, request: str, reply: str) -> DataFrame:
    """By model and in all (null): estimated tokens of both directions, their sum and the calls."""
    n = lambda c: F.coalesce(F.sum(F.floor(F.length(c) / 4)), F.lit(0))
    return calls.rollup(model).agg(n(request).alias("input_tokens"), n(reply).alias("output_tokens"), (n(request) + n(reply)).alias("total_tokens"), F.count("*").alias("calls"))


def filter_results(rows: DataFrame, **fields) -> DataFrame:
    """Rows that equal every given field; a field that the rows lack counts as null."""
    same = lambda name, value: (F.col(name) if name in rows.columns else F.lit(None)).eqNullSafe(F.lit(value))
    return rows.where(reduce(lambda a, b: a & b, [same(k, v) for k, v in fields.items()], F.lit(True)))


def sample_results(rows: DataFrame, n: int, *keys: str, seed: int = 42) -> DataFrame:
    """n rows in the seed's order; all, if there are fewer."""
    return rows.withColumn("_k", seeded_order(*keys, seed=seed)).orderBy("_k", *keys).limit(n).drop("_k")


def flatten_results(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """rows' columns of plain values, without nested ones and bytes, and each column of defaults, filled where it is null or absent."""
    plain = [f.name for f in rows.schema if f.dataType.typeName() not in ("array", "map", "struct", "binary", "variant")]
    return rows.select(*plain).withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in plain else F.lit(v) for c, v in defaults.items()})


def results_summary(qa: DataFrame, chunks: DataFrame, content: str, requested: int) -> DataFrame:
    """One row: questions, chunks, files' tokens in all and on average, and the number asked for."""
    c = chunks.agg(F.count("*").alias("chunks"), F.coalesce(F.sum(token_estimate(F.col(content))), F.lit(0)).alias("tokens"), F.avg(token_estimate(F.col(content))).alias("mean_tokens"))
    return qa.agg(F.count("*").alias("qa_pairs")).crossJoin(c).withColumn("requested", F.lit(requested).cast("long"))  # one row each


def dataset_rollup(stats: DataFrame, pages: DataFrame, file: str = "file_name", dataset: str = "dataset") -> DataFrame:
    """By dataset: files of either side, chunks, tokens, pages and their ratios. stats (dataset, file, chunks, tokens), pages (file, dataset, pages)."""
    both = stats.join(pages.withColumnRenamed(dataset, "_d"), file, "full_outer").groupBy(F.coalesce(F.col(dataset), F.col("_d")).alias(dataset))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    a = both.agg(F.count("*").alias("files"), total("chunks"), total("tokens"), total("pages"))
    return a.withColumns({"chunks_per_file": F.col("chunks") / F.col("files"), "tokens_per_page": F.when(F.col("pages") > 0, F.col("tokens") / F.col("pages")).otherwise(0.0)})


def corpus_stats(chunks: DataFrame, kind: str = "chunk_type", artifact: str = "artifact", content: str = "content", file: str = "file_name") -> DataFrame:
    """One row: chunks by kind, those with an artifact, tokens in all and on average, files."""
    tokens, is_ = token_estimate(F.col(content)), lambda *v: F.col(kind).isin(*v)
    return chunks.agg(
        F.count("*").alias("total"), F.count_if(is_("table")).alias("tables"), F.count_if(is_("standalone image")).alias("standalone_images"), F.count_if(~is_("table", "standalone image")).alias("texts"),
        F.count_if(~is_missing(F.col(artifact))).alias("multimodal"), F.sum(tokens).alias("tokens"), F.avg(tokens).alias("mean_tokens"), F.countDistinct(file).alias("files"),
    )


def context_stats(refs: DataFrame, key: str, hop_count: str) -> DataFrame:
    """By hop count: contexts and the mean and largest number of their chunks."""
    n = refs.groupBy(key).agg(F.max(hop_count).alias("hop_count"), F.count("*").alias("n"))
    return n.groupBy("hop_count").agg(F.count("*").alias("contexts"), F.avg("n").alias("mean_chunks"), F.max("n").alias("max_chunks"))


def qa_category_stats(rows: DataFrame, multihop: Column, multimodal: Column, relevance: str = "relevance_score", difficulty: str = "difficulty_score") -> DataFrame:
    """One row: questions by the two kinds with percentages to one decimal, and mean scores to two; without rows the percentages are null."""
    a, b = F.coalesce(multihop, F.lit(False)), F.coalesce(multimodal, F.lit(False))
    kinds = {"multihop": a, "multimodal": b, "both": a & b, "only_multihop": a & ~b, "only_multimodal": ~a & b, "neither": ~a & ~b}
    counts = [F.count_if(c).alias(n) for n, c in kinds.items()] + [F.bround(F.try_divide(100 * F.count_if(c), F.count("*")), 1).alias(f"{n}_pct") for n, c in kinds.items()]
    return rows.agg(F.count("*").alias("total"), *counts, *[F.bround(F.avg(F.col(c).try_cast("double")), 2).alias(n) for n, c in (("difficulty", difficulty), ("relevance", relevance))])


def artifact_counts(chunks: DataFrame, file: str = "file_name", artifact: str = "artifact", kind: str = "chunk_type") -> DataFrame:
    """By file and in all (null): distinct images that chunks refer to, and chunks that are tables."""
    images = F.explode_outer(F.when(~is_missing(F.col(artifact)), image_refs(F.col(artifact), F.col(file))))
    c = chunks.select(file, "chunk_id", F.col(kind).startswith("table").alias("is_table"), images.alias("path"))
    return c.rollup(file).agg(F.countDistinct("path").alias("images"), F.countDistinct(F.when(F.col("is_table"), F.struct(file, "chunk_id"))).alias("tables"))
