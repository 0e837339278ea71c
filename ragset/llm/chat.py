"""Chat formatting: a hidden Markov model recovers roles from raw transcript lines before turns are rendered.

A line's observation is its speaker marker's kind and a few features of the line; hidden states are (role, first line
of a turn or a later one). Start, transition and observation counts come from lines of known roles, summed by Spark.
A transcript is a sequence of lines; nothing that decoding sees depends on who spoke. Viterbi runs over stretches of
STRETCH lines of one transcript, each with up to MARGIN lines of context on both sides, so that a transcript of any
length never meets in one task; a line takes its state from the stretch that it belongs to. Turns open where a line's
state says so, by running counts over the stretches' sums, and are rendered line by line, without gathering a turn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ragset.llm.common import fold, staged

ROLES = ["system", "user", "assistant"]
#: Speaker markers by style; the last style has none. Fixed values.
MARKERS = {
    "system": ["System: ", "SYSTEM - ", "<|system|> ", "[Instructions] ", "Note: ", ""],
    "user": ["User: ", "HUMAN - ", "<|user|> ", "[Question] ", "Q: ", ""],
    "assistant": ["Assistant: ", "BOT - ", "<|assistant|> ", "[Answer] ", "A: ", ""],
}
#: Marker kinds by pattern, first match wins. Fixed values.
PATTERNS = [
    (r"(?i)^\s*(<\|?|\[|#+\s*)?(system|instructions?|note|context)\b\W{0,4}\s", 1),
    (r"(?i)^\s*(<\|?|\[|#+\s*)?(user|human|question|q|me|customer)\b\W{0,4}\s", 2),
    (r"(?i)^\s*(<\|?|\[|#+\s*)?(assistant|bot|answer|a|ai|agent|model)(\b\s*[:\]|>]\W{0,3}|\s+-)\s", 3),
    (r"^\s*[A-Z][A-Za-z ]{0,20}: ", 4),
]
STATES, SYMBOLS = 2 * len(ROLES), 5 * 2 * 3 * 2
#: Lines of a stretch, and of the context on either side. Turns counted together.
STRETCH, MARGIN, TURNS = 256, 64, 64


def numbered(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with first, the number of their transcript's lines before.

    Only counts are ordered, and by degrees: sums of TURNS turns, then of a turn's shares by a hash, then single rows.
    """
    n = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long") + 1
    own = staged(turns.withColumns({"n": n, "row": F.monotonically_increasing_id()}), "turns")
    own = own.withColumns({"many": F.floor(F.col("turn") / TURNS), "h": F.xxhash64("role", "text", "row")}).withColumn("share", F.shiftright("h", 58))
    before = lambda over: F.coalesce(F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    many = own.groupBy("conv_id", "many").agg(F.sum("n").alias("n")).select("conv_id", "many", before(Window.partitionBy("conv_id").orderBy("many")).alias("b1"))
    key = ["conv_id", "many", "turn", "share"]
    shares = own.groupBy(*key).agg(F.sum("n").alias("n")).select(*key, before(Window.partitionBy("conv_id", "many").orderBy("turn", "share")).alias("b2"))
    rows = own.select(*key, "row", before(Window.partitionBy(*key).orderBy("h", "row")).alias("b3"))
    first = rows.join(shares, key).join(many, ["conv_id", "many"]).select("row", (F.col("b1") + F.col("b2") + F.col("b3")).alias("first"))
    return own.select("row", "conv_id", "turn", "role", "text").join(first, "row")


def transcript_lines(turns: DataFrame) -> DataFrame:
    """(conv_id, at, line, truth, opens) of turns with first: the raw lines of transcripts, numbered by at, and what decoding must find.

    The conversation's id picks the marker style; a turn's first line carries the marker, an empty line ends the turn.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(6)).cast("int") + 1
    mark = F.coalesce(*(F.when(F.col("role") == r, F.element_at(F.array(*map(F.lit, MARKERS[r])), style)) for r in ROLES), F.lit(""))
    lines = F.split(F.concat(mark, F.coalesce("text", F.lit("")), F.lit("\n")), "\n")
    each = turns.select("conv_id", "first", "role", F.posexplode(lines).alias("part", "line"))
    return each.select("conv_id", (F.col("first") + F.col("part")).alias("at"), "line", F.col("role").alias("truth"), (F.col("part") == 0).alias("opens"))


def observed(line: Column, after_blank: Column) -> Column:
    """The observation of a line: marker kind, after an empty line or not, length, question mark."""
    kind = F.lit(0)
    for pattern, value in reversed(PATTERNS):
        kind = F.when(line.rlike(pattern), value).otherwise(kind)
    size = F.when(F.length(line) == 0, 0).when(F.length(line) < 200, 1).otherwise(2)
    return (((kind * 2 + after_blank.cast("int")) * 3 + size) * 2 + F.rtrim(line).endswith("?").cast("int")).cast("int")


def with_observations(lines: DataFrame) -> DataFrame:
    """lines with stretch, own (whether the line belongs to it or is context) and obs; of at and line alone."""
    home, place = F.floor(F.col("at") / STRETCH), F.col("at") % STRETCH
    to = F.array_compact(F.array(home, F.when(place < MARGIN, home - 1), F.when(place >= STRETCH - MARGIN, home + 1)))
    spread = lines.withColumns({"home": home, "stretch": F.explode(to)}).where("stretch >= 0")
    before = F.lag("line").over(Window.partitionBy("conv_id", "stretch").orderBy("at"))
    return spread.withColumns({"own": F.col("home") == F.col("stretch"), "obs": observed(F.col("line"), F.coalesce(before == "", F.lit(True)))}).drop("home")


def learn(lines: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log start, transition and observation probabilities from lines with truth, opens, stretch, own and obs; add-one counts."""
    role = F.coalesce(*(F.when(F.col("truth") == r, i) for i, r in enumerate(ROLES)))
    known = lines.withColumn("state", role * 2 + F.when(F.col("opens"), 0).otherwise(1))
    prior = F.when(F.col("at") == 0, -1).otherwise(F.coalesce(F.lag("state").over(Window.partitionBy("conv_id", "stretch").orderBy("at")), F.lit(-2)))
    counts = known.withColumn("prior", prior).where("own and state is not null").groupBy("prior", "state", "obs").count().collect()  # states x states x symbols at most
    start, trans, emit = np.ones(STATES), np.ones((STATES, STATES)), np.full((STATES, SYMBOLS), 0.1)
    for r in counts:
        emit[r["state"], r["obs"]] += r["count"]
        if r["prior"] >= 0:
            trans[r["prior"], r["state"]] += r["count"]
        elif r["prior"] == -1:
            start[r["state"]] += r["count"]
    return np.log(start / start.sum()), np.log(trans / trans.sum(1, keepdims=True)), np.log(emit / emit.sum(1, keepdims=True))


def viterbi(obs: np.ndarray, start: np.ndarray, trans: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """The likeliest states of a run of lines. Ties go to the lower state."""
    n = len(obs)
    best, back = start + emit[:, obs[0]], np.zeros((n, STATES), np.int8)
    for i in range(1, n):
        step = best[:, None] + trans
        back[i] = step.argmax(axis=0)
        best = step[back[i], np.arange(STATES)] + emit[:, obs[i]]
    out = np.empty(n, np.int64)
    out[-1] = int(best.argmax())
    for i in range(n - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def decode(lines: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """(conv_id, turn_no, part, role, text, begins, ends) of the recovered turns, a row for each stretch that a turn runs through; the marker and the closing empty line are removed."""
    sent = lines.sparkSession.sparkContext.broadcast(model)
    groups = lines.groupBy("conv_id", "stretch").agg(F.sort_array(F.collect_list(F.struct("at", "own", "obs", F.when(F.col("own"), F.col("line")).alias("line")))).alias("rows"))  # STRETCH + 2 * MARGIN lines at most
    marker = "|".join(f"(?:{p})" for p, _ in PATTERNS[:3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        cut = re.compile(marker.replace("(?i)", ""), re.IGNORECASE)
        start, trans, emit = sent.value
        for batch in batches:
            out: list[tuple] = []
            for conv, stretch, rows in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "stretch", "rows"))):
                states = viterbi(np.array([r["obs"] for r in rows]), start if rows[0]["at"] == 0 else np.zeros(STATES), trans, emit)
                pieces: list[tuple[int, bool, list[str]]] = []  # role, whether its first line opens a turn, lines
                for r, s in zip(rows, states.tolist()):
                    if not r["own"]:
                        continue
                    if s % 2 == 0 or not pieces or pieces[-1][0] != s // 2:
                        opens = s % 2 == 0 or bool(pieces) or r["at"] == 0
                        pieces.append((s // 2, opens, [cut.sub("", r["line"], count=1) if opens else r["line"]]))
                    else:
                        pieces[-1][2].append(r["line"])
                out += [(conv, stretch, k, role, opens, k == 0, k == len(pieces) - 1, "\n".join(part)) for k, (role, opens, part) in enumerate(pieces)]
            cols = list(zip(*out)) or [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["conv_id", "stretch", "k", "role_no", "opens", "head", "tail", "text"])

    pieces = staged(groups.mapInArrow(run, "conv_id long, stretch long, k int, role_no int, opens boolean, head boolean, tail boolean, text string"), "pieces")
    # a row a stretch: what the next one needs to know
    ends = pieces.groupBy("conv_id", "stretch").agg(
        F.max(F.when(F.col("head"), F.col("role_no"))).alias("r0"), F.max(F.when(F.col("head"), F.col("opens"))).alias("o0"), F.max(F.when(F.col("tail"), F.col("role_no"))).alias("r1"), F.count("*").alias("n")
    )
    along = Window.partitionBy("conv_id").orderBy("stretch")
    ends = ends.withColumn("starts", F.col("o0") | F.coalesce(F.lag("r1").over(along) != F.col("r0"), F.lit(True)))
    ends = ends.withColumn("base", F.sum(F.col("n") - 1 + F.col("starts").cast("int")).over(along) - F.col("n")).withColumn("stops", F.coalesce(F.lead("starts").over(along), F.lit(True)))
    each = pieces.join(ends.select("conv_id", "stretch", "starts", "stops", "base"), ["conv_id", "stretch"])
    begins, over = ~F.col("head") | F.col("starts"), ~F.col("tail") | F.col("stops")
    closed = F.when(F.length("text") > 0, F.regexp_replace("text", "\n$", "")).otherwise(F.col("text"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("role_no") + 1)
    return each.select("conv_id", (F.col("base") + F.col("k")).alias("turn_no"), F.col("stretch").alias("part"), role.alias("role"), F.when(over, closed).otherwise(F.concat("text", F.lit("\n"))).alias("text"), begins.alias("begins"), over.alias("ends"))


def rendered(turns: DataFrame) -> DataFrame:
    """turns with their canonical text: role header, text, end mark; of a turn in parts the header in the first, the mark in the last."""
    inner = F.when(F.col("begins") & F.col("ends"), F.trim("text")).when(F.col("begins"), F.ltrim("text")).when(F.col("ends"), F.rtrim("text")).otherwise(F.col("text"))
    head, tail = F.when(F.col("begins"), F.concat(F.lit("<|"), "role", F.lit("|>\n"))).otherwise(""), F.when(F.col("ends"), F.lit("<|end|>\n")).otherwise("")
    return turns.withColumn("rendered", F.concat(head, inner, tail))


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, turn_no, part, role, n_chars, rendered_crc32 of the turns recovered from the conversations' transcripts, a row for each stretch of lines that a turn runs through.

    The model learns from the conversations whose crc32(conv_id as text) mod 5 is not 0. A null text is an empty line;
    a null turn counts as -1, unknown roles have no marker and teach nothing; rows without a conv_id take no part. Rows
    of one conversation and turn follow each other in an order by hash and never mix. Other columns are ignored; an
    empty table gives no rows.
    """
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("turn", F.lit(-1)).cast("long").alias("turn"), "role", "text")
    lines = staged(with_observations(transcript_lines(numbered(turns))), "lines")
    model = learn(lines.where(fold("conv_id", 5) != 0))
    found = rendered(decode(lines, model))
    return found.select("conv_id", "turn_no", "part", "role", F.length("text").cast("long").alias("n_chars"), F.crc32(F.col("rendered").cast("binary")).alias("rendered_crc32"))
