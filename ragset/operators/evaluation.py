"""Evaluation of a dataset: parsed claims, multimodal and reasoning scores, coverage, subsets and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragset.functions.text import clean, is_missing
from ragset.operators.metrics import necessity, visual_dependency
from ragset.operators.replies import VISUAL_QUESTION

#: The metrics of an evaluation, and which of them need images.
METRICS = [
    ("faithfulness", False, "FULL"),
    ("answer_relevance", False, "FULL"),
    ("context_precision", False, "APPROXIMATED"),
    ("context_recall", False, "APPROXIMATED"),
    ("multihop_reasoning", False, "FULL"),
    ("visual_dependency", True, "FULL"),
    ("multimodal_faithfulness_vlm", True, "FULL"),
    ("multimodal_answer_quality_vlm", True, "FULL"),
    ("semantic_diversity", False, "FULL"),
    ("context_necessity", False, "FULL"),
]


def _zero_one(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def _section(reply: Column, name: str, until: str) -> Column:
    """The text after 'name:' and a line end, up to the next section's name or the reply's end; null if absent."""
    stop = rf"(?={until}:|\z)" if until else r"\z"
    pattern = rf"(?s){name}:\s*\n(.*?){stop}"
    return F.when(reply.rlike(pattern), F.regexp_extract(reply, pattern, 1))


def _items(section: Column) -> Column:
    lines = F.filter(F.transform(F.split(clean(section), "\n"), clean), lambda x: (x != "") & (x != "-"))
    return F.coalesce(F.transform(lines, lambda x: clean(F.regexp_replace(x, "^[- ]+", ""))), F.array().cast("array<string>"))


def parse_claims(rows: DataFrame, reply: str = "reply", question: str = "question", answer: str = "answer", reference: str = "reference", most: int = 3) -> DataFrame:
    """rows with answer_claims, reference_claims, reverse_questions (at most `most`) and concept_hops of a preparation reply.

    A missing reply or an error gives the answer, the reference and the question themselves; an absent section is empty.
    """
    r = F.col(reply)
    bad = r.isNull() | r.startswith("ERROR:")
    own = lambda c: F.array_compact(F.array(F.when(F.col(c) != "", F.col(c))))
    hops = F.coalesce(clean(_section(r, "CONCEPT_HOPS_QUESTION", "REVERSE_QUESTIONS")), F.lit(""))
    return rows.withColumns(
        {
            "answer_claims": F.when(bad, own(answer)).otherwise(_items(_section(r, "ANSWER_CLAIMS", "REFERENCE_CLAIMS"))),
            "reference_claims": F.when(bad, own(reference)).otherwise(_items(_section(r, "REFERENCE_CLAIMS", "REVERSE_QUESTIONS"))),
            "reverse_questions": F.when(bad, F.array(F.col(question))).otherwise(F.slice(_items(_section(r, "REVERSE_QUESTIONS", "")), 1, most)),
            "concept_hops": F.when(bad, F.lit("")).otherwise(hops),
        }
    )


def sourced_verdicts(reply: Column, n: Column) -> Column:
    """An array of (supported, source) of claims 1..n: a claim's first verdict with a source, else its first one without (UNKNOWN), else unsupported."""
    found = lambda pattern, k: F.regexp_extract_all(reply, F.lit(pattern), F.lit(k))
    full, bare = r"(?i)CLAIM_([0-9]+):\s*(SUPPORTED|NOT_SUPPORTED)\s*\|\s*SOURCE:\s*(TEXT|IMAGE|BOTH|NONE)", r"(?i)CLAIM_([0-9]+):\s*(SUPPORTED|NOT_SUPPORTED)"
    ids, said, sources = (found(full, k) for k in (1, 2, 3))
    ids2, said2 = (found(bare, k) for k in (1, 2))

    def one(i: Column) -> Column:
        at, at2 = F.array_position(ids, i.cast("string")).cast("int"), F.array_position(ids2, i.cast("string")).cast("int")
        yes = lambda words, p: ~F.upper(F.try_element_at(words, p)).contains("NOT")
        return F.struct(
            F.when(at > 0, yes(said, at)).when(at2 > 0, yes(said2, at2)).otherwise(False).alias("supported"), F.when(at > 0, F.upper(F.try_element_at(sources, at))).otherwise("UNKNOWN").alias("source")
        )

    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n.cast("int")), one)).otherwise(F.array().cast("array<struct<supported:boolean,source:string>>"))


def multimodal_faithfulness(items: DataFrame, reply: str, n: str, has_image: str, text_score: str, n_chunks: str) -> DataFrame:
    """items with score, text_claims, image_claims, text_grounded and visual_grounded.

    Without chunks the score is 0 and without images the text score; an error gives 0, no claims give 1.
    """
    r = F.coalesce(F.col(reply), F.lit("ERROR: no reply"))
    v = items.withColumn("_v", sourced_verdicts(r, F.col(n)))
    good = F.filter("_v", lambda x: x["supported"])
    of = lambda kinds: F.size(F.filter(good, lambda x: x["source"].isin(kinds))).cast("long")
    seen = (F.col(n_chunks) > 0) & F.col(has_image) & ~r.startswith("ERROR:")
    share = F.when(F.size("_v") > 0, F.size(good) / F.size("_v")).otherwise(1.0)
    v = v.withColumns({"text_claims": F.when(seen, of(["TEXT", "BOTH"])).otherwise(0), "image_claims": F.when(seen, of(["IMAGE", "BOTH"])).otherwise(0)})
    score = F.when(F.coalesce(F.col(n_chunks), F.lit(0)) == 0, 0.0).when(~F.col(has_image), F.col(text_score)).when(r.startswith("ERROR:"), 0.0).otherwise(share)
    grounded = lambda c, mark: (F.col(c) > 0) | (seen & F.upper(r).contains(f"{mark}: YES"))
    return v.withColumns({"score": score, "text_grounded": grounded("text_claims", "TEXT_GROUNDED"), "visual_grounded": grounded("image_claims", "VISUAL_GROUNDED")}).drop("_v")


def labelled_score(reply: Column, label: str, default: float = 0.5) -> Column:
    """The number after 'label:' within 0 and 1; default where there is none."""
    x = F.regexp_extract(F.coalesce(reply, F.lit("")), rf"(?i){label}:\s*([0-9.]+)", 1).try_cast("double")
    return F.when(x.isNull(), F.lit(default)).otherwise(_zero_one(x))


def labelled_flag(reply: Column, label: str) -> Column:
    """YES, NO or NA after the label, its words joined by '_' or a space; null if absent."""
    x = F.regexp_extract(F.coalesce(reply, F.lit("")), rf"(?i){label.replace('_', '[_ ]')}(?::\s*|<\|#\|>)(YES|NO|NA)", 1)
    return F.when(x != "", F.upper(x))


def multimodal_relevance(model: Column, embedding: Column, has_image: Column) -> Column:
    """Half the model's score and half the embedding's where that is positive; without images the embedding's alone."""
    m = _zero_one(F.coalesce(model, F.lit(0.5)))
    return F.when(~has_image, embedding).when(embedding > 0, 0.5 * m + 0.5 * embedding).otherwise(m)


def necessity_report(rows: DataFrame, label: str) -> DataFrame:
    """One row: mean necessity, answerable rows, their share and the counts of three levels."""
    n = rows.select(necessity(F.col(label)).alias("x"))
    leak = F.count_if(F.col("x") == 0)
    return n.agg(
        F.avg("x").alias("mean"), leak.alias("answerable"), F.try_divide(leak, F.count("*")).alias("leakage_rate"),
        F.count_if(F.col("x") >= 0.8).alias("high"), F.count_if((F.col("x") >= 0.5) & (F.col("x") < 0.8)).alias("medium"), F.count_if(F.col("x") < 0.5).alias("low"),
    )


def multihop_report(judged: DataFrame) -> DataFrame:
    """By hop count and in all (null): rows, mean score and rows that name a bridge; of multihop_reasoning's columns."""
    return judged.rollup(F.col("hop_count").alias("hops")).agg(F.count("*").alias("n"), F.avg("reasoning_score").alias("score"), F.count_if(~F.col("bridge_entity").isin("None", "Error")).alias("bridges"))


def visual_report(rows: DataFrame, reply: str) -> DataFrame:
    """One row: rows whose visual is essential, helpful or needless, the mean score and the share of essential ones."""
    x = rows.select(visual_dependency(F.col(reply)).alias("x"))
    is_ = lambda v: F.count_if(F.col("x") == v)
    return x.agg(F.count("*").alias("n"), is_(1.0).alias("essential"), is_(0.5).alias("helpful"), is_(0.0).alias("sufficient"), F.avg("x").alias("mean"), F.try_divide(is_(1.0), F.count("*")).alias("necessity_rate"))


def divergence(corpus: DataFrame, refs: DataFrame, key: str, eps: float = 1e-10) -> DataFrame:
    """One row (jsd): the Jensen-Shannon divergence of references per key from the corpus's rows per key; null without references."""
    per = corpus.groupBy(key).agg(F.count("*").alias("cn")).join(refs.groupBy(key).agg(F.count("*").alias("rn")), key, "left").fillna(0, ["rn"])
    sums = per.agg(F.sum("cn").alias("cs"), F.sum("rn").alias("rs"))
    p, q = F.try_divide(F.col("rn"), F.col("rs")) + eps, F.try_divide(F.col("cn"), F.col("cs")) + eps
    m = (p + q) / 2
    return per.crossJoin(sums).agg(F.sum(0.5 * p * F.log(p / m) + 0.5 * q * F.log(q / m)).alias("jsd"))  # sums is one row


def domain_coverage(chunks: DataFrame, refs: DataFrame, file: str = "file_name", chunk: str = "chunk_id") -> DataFrame:
    """One row: chunks and files, those that references cover, uncovered chunks and the divergence of references from the corpus."""
    c, r = chunks.select(file, chunk), refs.select(file, chunk)
    hit = c.join(r.distinct().withColumn("_hit", F.lit(1)), [file, chunk], "left")
    n = hit.agg(F.count("*").alias("chunks"), F.countDistinct(file).alias("files"), F.count("_hit").alias("covered_chunks"), F.countDistinct(F.when(F.col("_hit") == 1, F.col(file))).alias("covered_files"))
    return n.crossJoin(divergence(c, r, file)).withColumn("uncovered", F.col("chunks") - F.col("covered_chunks"))  # one row each


def coverage_by(chunks: DataFrame, refs: DataFrame, *by: str, keys: tuple[str, ...] = ("file_name", "chunk_id")) -> DataFrame:
    """By each column of `by` in turn: chunks, covered ones and their share."""
    hit = refs.select(*keys).distinct().withColumn("_hit", F.lit(1))
    j = chunks.select(*dict.fromkeys([*keys, *by])).join(hit, list(keys), "left")
    return j.groupingSets([[F.col(c)] for c in by], *[F.col(c) for c in by]).agg(F.count("*").alias("n"), F.count("_hit").alias("covered"), (F.count("_hit") / F.count("*")).alias("rate"))


def uncovered_chunks(chunks: DataFrame, refs: DataFrame, keys: tuple[str, ...] = ("file_name", "chunk_id")) -> DataFrame:
    return chunks.select(*keys).join(refs.select(*keys).distinct(), list(keys), "left_anti")


def aggregate_scores(rows: DataFrame, scores: list[str], positive: list[str], error: str, hops: str, *by: Column | str) -> DataFrame:
    """Means of scores over rows without an error, the numbers of both kinds, means of the positive values of `positive`,
    and the mean number of arrows of the rows that have concept hops; in all, or by columns."""
    ok = F.col(error).isNull()
    text = F.coalesce(F.col(hops), F.lit(""))
    arrows = F.when(ok & (text != ""), F.regexp_count(text, F.lit("-->")))
    out = [F.avg(F.when(ok, F.col(c))).alias(c) for c in scores] + [F.count_if(ok).alias("evaluated"), F.count_if(~ok).alias("errors")]
    out += [F.avg(F.when(ok & (F.col(c) > 0), F.col(c))).alias(f"{c}_valid") for c in positive]
    out += [F.coalesce(F.avg(arrows), F.lit(0.0)).alias("mean_hops"), F.count(arrows).alias("hops_count")]
    return rows.groupBy(*by).agg(*out) if by else rows.agg(*out)


def subset_flags(rows: DataFrame, hop_count: str, question: str, image: str) -> DataFrame:
    """rows with multihop and multimodal: hops above 0; an image or words of a figure in the question."""
    seen = ~is_missing(F.col(image)) | F.coalesce(F.col(question).rlike(VISUAL_QUESTION), F.lit(False))
    return rows.withColumns({"multihop": F.coalesce(F.col(hop_count), F.lit(0)) > 0, "multimodal": seen})


def subset_counts(flagged: DataFrame) -> DataFrame:
    """One row of the numbers of rows by the two flags."""
    a, b = F.col("multihop"), F.col("multimodal")
    return flagged.agg(F.count("*").alias("total"), F.count_if(a).alias("multihop"), F.count_if(b).alias("multimodal"), F.count_if(a & b).alias("both"), F.count_if(~a).alias("not_multihop"), F.count_if(~b).alias("not_multimodal"), F.count_if(~a & ~b).alias("neither"))


def by_subset(flagged: DataFrame) -> DataFrame:
    """flagged once for each subset that a row is in (column subset): all, multihop, multimodal, both."""
    a, b = F.col("multihop"), F.col("multimodal")
    names = F.array_compact(F.array(F.lit("all"), F.when(a, F.lit("multihop")), F.when(b, F.lit("multimodal")), F.when(a & b, F.lit("both"))))
    return flagged.withColumn("subset", F.explode(names))


def attach_metrics(details: DataFrame, key: str, *metrics: DataFrame) -> DataFrame:
    """details with each metric's columns where it has the key; rows without one keep nulls."""
    return reduce(lambda d, m: d.join(m, key, "left"), metrics, details)


def data_completeness(rows: DataFrame, n_images: str, has_lineage: bool = True) -> DataFrame:
    """(metric, can_evaluate, quality, items, items_with_images, images): what can be measured, and how well; rows are counted once."""
    n = rows.agg(F.count("*").alias("items"), F.count_if(F.col(n_images) > 0).alias("items_with_images"), F.coalesce(F.sum(n_images), F.lit(0)).cast("long").alias("images"))
    table = [*METRICS, ("domain_coverage", False, "FULL" if has_lineage else "LIMITED")]
    metrics = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(v).alias("visual"), F.lit(q).alias("q")) for m, v, q in table])
    can = ~F.col("m.visual") | (F.col("items_with_images") > 0)
    return n.withColumn("m", F.explode(metrics)).select("m.metric", can.alias("can_evaluate"), F.when(can, F.col("m.q")).otherwise("NOT_APPLICABLE").alias("quality"), "items", "items_with_images", "images")


def basic_report(rows: DataFrame, status: str = "context_status", domain: str = "domain", relevance: str = "relevance_score", difficulty: str = "difficulty_score") -> DataFrame:
    """(kind, value, n, relevance, difficulty): rows by status, by domain and in all, and the mean scores of those that have a number; a missing status or domain is UNKNOWN."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("UNKNOWN"))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in (("status", known(status)), ("domain", known(domain)), ("all", F.lit(None).cast("string")))))
    scores = [F.col(c).try_cast("double").alias(n) for c, n in ((relevance, "relevance"), (difficulty, "difficulty"))]
    return rows.select(*scores, F.explode(kinds).alias("k")).groupBy("k.kind", "k.value").agg(F.count("*").alias("n"), F.avg("relevance").alias("relevance"), F.avg("difficulty").alias("difficulty"))


#: What a question carries along into evaluation.
METADATA = ["chunk_id", "hop_count", "context_status", "depth_reached", "expert_persona", "domain", "relevance_score", "difficulty_score", "selection_status"]


def to_eval_rows(rows: DataFrame, chunks: str = "context_chunks") -> DataFrame:
    """rows' question and answer with ground_truth, contexts, image_contexts, type, metadata and the chunks themselves.

    rows have question, answer, chunks (an array of structs with content and image_path), final_context and original_chunk. Contexts
    are the chunks' contents that are not empty; without chunks, the final context, or where that is null the original chunk. The ground
    truth is the answer. Images are the chunks' paths but for 'null'; a row with one is of type visual. metadata holds those of METADATA that rows have.
    """
    own = F.coalesce(F.col(chunks), F.array().cast(dict(rows.dtypes)[chunks]))
    texts = F.filter(F.transform(own, lambda c: c["content"]), lambda x: x.isNotNull() & (x != ""))
    contexts = F.when(F.size(own) > 0, texts).otherwise(F.array(F.coalesce("final_context", "original_chunk", F.lit(""))))
    images = F.filter(F.transform(own, lambda c: c["image_path"]), lambda x: x.isNotNull() & (x != "") & (x != "null"))
    kept = [c for c in rows.columns if c not in ("question", "answer", chunks, "final_context", "original_chunk", *METADATA)]
    meta = F.struct(*[F.col(c) for c in METADATA if c in rows.columns] or [F.lit(None).cast("string").alias("chunk_id")])
    return rows.select(
        *kept, F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("answer"), F.coalesce("answer", F.lit("")).alias("ground_truth"),
        contexts.alias("contexts"), images.alias("image_contexts"), F.when(F.size(images) > 0, "visual").otherwise("text").alias("type"), meta.alias("metadata"), own.alias(chunks),
    )


def group_means(report: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """report with the mean of each group's columns that are not null, as <group>_mean; null where all are."""
    for name, columns in groups.items():
        present = F.array_compact(F.array(*[F.col(c).cast("double") for c in columns]))
        report = report.withColumn(f"{name}_mean", F.when(F.size(present) > 0, F.aggregate(present, F.lit(0.0), lambda a, x: a + x) / F.size(present)))
    return report
