"""N-gram Jaccard join: grouped prefix join.

Documents of one shingle set are one representative; representatives of one prefix and size are one group. Groups meet
where they share a shingle of their prefixes (rarest first, by a sketch of the shingles' frequencies), sizes and
positions are tested, and the members' sets decide. Members of one group meet by the group itself, as other groups
need not hold its prefix. What has been linked already needs no more tests: first, rounds of stars compare every group
of a shingle, and every member of a group, with one hub; the last round compares all pairs that are left in different
components, so that no link between components is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragset.llm.common import staged, tidy
from ragset.llm.graph import components
from ragset.llm.shingles import shingle_sets

SLOTS, BLOCK, MOST_BITS = 1 << 20, 1 << 14, 30
#: Sets of up to so many shingles are compared by 48 bits of their hashes.
SHORT = 1 << 12
#: Rows of one shingle that meet in one task of the last round.
TILE = 1024


def frequency_sketch(docs: DataFrame, words: int) -> np.ndarray:
    """For each slot of the hashed shingles, the log of how many documents hold one: a byte a slot, whatever the corpus."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int32)
        for batch in batches:
            for h in shingle_sets(batch.column("text").to_pylist(), words):
                total[(h % np.uint64(SLOTS)).astype(np.int64)] += 1  # two shingles of one text in a slot count once
        full = [k for k in range(SLOTS // BLOCK) if total[k * BLOCK : (k + 1) * BLOCK].any()]
        yield pa.RecordBatch.from_pydict({"block": pa.array(full, pa.int32()), "v": pa.array([total[k * BLOCK : (k + 1) * BLOCK].tobytes() for k in full], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column("block").to_pylist(), batch.column("v").to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(v, np.int32).astype(np.int64)
        logs = [np.ceil(8 * np.log2(1 + v)).clip(0, 255).astype(np.uint8).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_pydict({"block": pa.array(list(sums), pa.int32()), "v": pa.array(logs, pa.binary())})

    out = np.zeros(SLOTS, np.uint8)
    for r in docs.select("text").mapInArrow(tidy(own), "block int, v binary").repartition(SLOTS // BLOCK, "block").mapInArrow(tidy(add), "block int, v binary").collect():
        out[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["v"], np.uint8)
    return out


def prefixes(docs: DataFrame, words: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """(doc_id, n, digest of the set, group g: hash of prefix and size, prefix), digest null for an empty set."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = sent.value
        for batch in batches:
            n, digest, g, prefix = [], [], [], []
            for h in shingle_sets(batch.column("text").to_pylist(), words):
                n.append(len(h))
                if not len(h):
                    digest.append(None), g.append(None), prefix.append([])
                    continue
                # an order that all documents share: frequency, then the hash itself
                first = h[np.argsort(order[(h % np.uint64(SLOTS)).astype(np.int64)], kind="stable")][: len(h) - -(-percent * len(h) // 100) + 1]
                digest.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                g.append(int.from_bytes(hashlib.blake2b(first.tobytes() + len(h).to_bytes(8, "little"), digest_size=8).digest(), "little", signed=True))
                prefix.append(first.view(np.int64))
            cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(g, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n", "digest", "g", "prefix"])

    return docs.mapInArrow(tidy(run), "doc_id long, n long, digest binary, g long, prefix array<long>")


def met(lists: DataFrame, total: int, least: int, spare: int = 2, among=None) -> np.ndarray:
    """A bit a slot of the hashes in the array column v: whether least of them (1 or 2) or more fall there; 2^MOST_BITS bits at most. With a broadcast bitmap among, of rows whose column h it holds."""
    bits = min(MOST_BITS, max(20, int(total).bit_length() + spare))
    part = 1 << 18

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _held(batch, among)
            slot = np.sort((np.array(batch.column("v").flatten()).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64))
            ranges = np.unique(slot // part)
            cuts = np.searchsorted(slot, [*(ranges * part), 1 << bits])
            rows = [(slot[a:b] % part).astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array(rows, pa.binary())], ["range", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column("range").to_pylist(), batch.column("v").to_pylist()):
                got = np.minimum(np.bincount(np.frombuffer(v, "<u4"), minlength=part), 2).astype(np.uint8)
                seen[k] = np.minimum(seen[k] + got, 2) if k in seen else got
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array([np.packbits(c >= least).tobytes() for c in seen.values()], pa.binary())], ["range", "v"])

    out = np.zeros((1 << bits) // 8, np.uint8)
    counted = lists.select("v", *(["h"] if among else [])).mapInArrow(tidy(own), "range int, v binary").repartition(max(64, (1 << bits) // part // 16), "range")
    for r in counted.mapInArrow(tidy(add), "range int, v binary").collect():
        out[r["range"] * part // 8 : (r["range"] + 1) * part // 8] = np.frombuffer(r["v"], np.uint8)
    return out


def _marked(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bitmap of met() holds these hashes."""
    bits = (len(bitmap) * 8).bit_length() - 1
    slot = (h.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[slot >> 3] >> (7 - (slot & 7)) & 1).astype(bool)


def _held(batch: pa.RecordBatch, among) -> pa.RecordBatch:
    """The rows whose column h the broadcast bitmap holds; all without one."""
    return batch.filter(pa.array(_marked(among.value, np.asarray(batch.column("h"))))) if among else batch


def sent_bitmap(keys: DataFrame, by: list[str]):
    """A broadcast bitmap of xxhash64 of the columns by: holds all rows of keys, and few others. What it sends has a fixed bound at any size."""
    return keys.sparkSession.sparkContext.broadcast(met(keys.select(F.array(F.xxhash64(*by)).alias("v")), keys.count(), 1, 4))


def possible(keys: DataFrame, by: list[str]) -> Column:
    """A condition on the columns by: holds for all rows that are in keys, and for few others."""
    sent = sent_bitmap(keys, by)

    @F.arrow_udf("boolean")
    def hit(h: pa.Array) -> pa.Array:
        return pa.array(_marked(sent.value, np.asarray(h)))

    return hit(F.xxhash64(*by))


def prefix_tokens(sets: DataFrame, twice: np.ndarray, among=None) -> DataFrame:
    """(token, g, n, pos) of the prefixes' shingles that another document may hold; with a broadcast bitmap among, of rows whose column h it holds."""
    sent = sets.sparkSession.sparkContext.broadcast(twice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _held(batch, among)
            lists = batch.column("prefix")
            token = np.array(lists.flatten())
            size = np.diff(np.array(lists.offsets))
            pos = np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)
            keep = np.flatnonzero(_marked(sent.value, token))
            row = np.repeat(np.arange(batch.num_rows), size)[keep]
            cols = [token[keep], np.array(batch.column("g"))[row], np.array(batch.column("n"))[row].astype(np.int32), pos[keep].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["token", "g", "n", "pos"])

    return sets.select("g", "n", "prefix", *(["h"] if among else [])).mapInArrow(run, "token long, g long, n int, pos int")


def sent_set(h: np.ndarray) -> bytes:
    """A sorted set for read_sets: six upper bytes of a hash where there are few, all eight where there are many; after them a byte that says how many."""
    left_out = 2 if len(h) <= SHORT else 0
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, left_out:].tobytes() + bytes([8 - left_out])


def read_sets(*sent) -> list[np.ndarray]:
    """Sets of sent_set, by as many bytes of a hash as each of them has. Two of SHORT shingles or fewer share one by chance in 1 of 16 million pairs, of 500 in 1 of 10^9."""
    out, shortest = [], 8
    for s in sent:
        raw = np.frombuffer(s, np.uint8)
        size = int(raw[-1])
        whole = np.zeros(((len(raw) - 1) // size, 8), np.uint8)
        whole[:, 8 - size :] = raw[:-1].reshape(-1, size)
        out.append(whole.view("<u8").ravel())
        shortest = min(shortest, size)
    return [h & np.uint64((1 << 64) - (1 << 8 * (8 - shortest))) for h in out]


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of documents whose sets are similar enough."""
    ids = staged(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "ids")

    sent = sent_bitmap(ids, ["doc_id"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _held(batch, sent)
            got = [sent_set(h) for h in shingle_sets(batch.column("text").to_pylist(), words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got, pa.binary())], ["doc_id", "s"])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb")):
                x, y = read_sets(sa.as_buffer(), sb.as_buffer())
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # the bitmap is tested where the sets are made: two Python workers a task would hold twice the memory
    known = full(staged(docs.select("doc_id", "text", F.xxhash64("doc_id").alias("h")).mapInArrow(tidy(sets), "doc_id long, s binary"), "sets"))
    of = lambda c: known.select(F.col("doc_id").alias(c), F.col("s").alias(f"s{c}"))
    return staged(pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(tidy(test), "a long, b long"), "links")


def _possible(percent: int, n1: str, n2: str, p1: str, p2: str) -> Column:
    """Sizes, and what can still follow the shingle at these positions of the prefixes."""
    least, most = F.least(n1, n2), F.greatest(n1, n2)
    rest = F.least(F.col(n1) - F.col(p1), F.col(n2) - F.col(p2))
    return (100 * least >= percent * most) & ((100 + percent) * rest >= percent * (F.col(n1) + F.col(n2)))


def full(rows: DataFrame) -> DataFrame:
    """rows, of which no column is null. Else a join adds that test to one of its sides alone, and equal sides are made and shuffled twice."""
    return rows.where(" and ".join(f"{c} is not null" for c in rows.columns))


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of those shingles that more than one component holds, with the number of the shingle's rows."""
    mixed = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("held")).where("lo < hi").select("token", "held")
    return rows.join(mixed, "token")


def ngram_join(docs: DataFrame, words: int = 4, percent: int = 85, stars: int = 3) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of docs.

    Documents link when 100 * intersection >= percent * union of their shingle sets (64-bit hashes). component_id is
    the smallest doc_id that links lead to, the document's own included. A null or empty text has an empty set and no
    links. A row with a null doc_id has a null component_id and no links. Rows of one doc_id are one document for the
    links: its texts are linked, and a row of it without shingles has its component. Other columns are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    all_sets = staged(prefixes(docs, words, percent, frequency_sketch(docs, words)), "prefixes")
    named = all_sets.where("digest is not null and doc_id is not null")
    first = staged(named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("g").alias("g"), F.max("n").cast("int").alias("n")), "first")
    groups = staged(first.groupBy("g").agg(F.min("rep").alias("gid")), "groups")
    members = full(staged(first.join(groups, "g").select("g", "gid", "rep", "n"), "members"))
    # members beside the hub, which is tested first; two sets of one size differ in a shingle each and link only if large enough
    inner = members.where("gid <> rep").where((100 + percent) * (F.col("n") - 1) >= 2 * percent * F.col("n")).select(F.col("g").alias("token"), "rep", "n", F.lit(0).alias("pos"))
    # a group's prefix counts once, by the row of its smallest document: copies alone make no shingle met
    lead, hashed = sent_bitmap(groups.select(F.col("gid").alias("doc_id"), "g"), ["doc_id", "g"]), named.withColumn("h", F.xxhash64("doc_id", "g"))
    total = named.agg(F.coalesce(F.sum(F.size("prefix")), F.lit(0))).first()[0]
    own = prefix_tokens(hashed, met(hashed.select(F.col("prefix").alias("v"), "h"), total, 2, among=lead), lead)
    often = own.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo < hi").select("token")
    # written files say nothing about nulls; said here, all uses of the rows read and shuffle the same ones, once
    tokens = full(staged(own.join(often, "token").distinct(), "tokens"))

    links = verified(members.where("gid <> rep").select(F.col("gid").alias("a"), F.col("rep").alias("b")), docs, words, percent)
    # documents of several rows: their texts are linked
    several = staged(all_sets.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    repeated = not several.isEmpty()
    if repeated:
        texts = named.join(several, "doc_id").select("doc_id", "digest").distinct().join(first.select("digest", "rep"), "digest").groupBy("doc_id").agg(F.collect_set("rep").alias("reps"))
        same = texts.select(F.array_min("reps").alias("a"), F.explode("reps").alias("b")).where("a < b").distinct()
        links = links.union(staged(same, "same"))
    label, tested = staged(components(links), "label"), None
    for turn in range(stars):
        # a hub of each shingle: in turn the smallest group, then others by a hash; rows in the hub's component are done
        named_groups = members.select("g", "gid").distinct().join(label, F.col("gid") == F.col("node"), "left").select("g", "gid", F.coalesce("component", "gid").alias("component"))
        named_inner = inner.join(label, F.col("rep") == F.col("node"), "left").select("token", F.col("rep").alias("gid"), "n", "pos", F.coalesce("component", "rep").alias("component"))
        rows = tokens.join(named_groups, "g").select("token", "gid", "n", "pos", "component").union(named_inner)
        rank = F.struct(*([F.xxhash64("gid", F.lit(turn)).alias("r")] if turn else []), "gid", "n", "pos", "component")
        hubs = rows.groupBy("token").agg(F.min(rank).alias("h")).select("token", F.col("h.gid").alias("a"), F.col("h.n").alias("na"), F.col("h.pos").alias("pa"), F.col("h.component").alias("ca"))
        pairs = rows.join(hubs, "token").where(F.col("component") != F.col("ca")).where(_possible(percent, "n", "na", "pos", "pa"))
        pairs = pairs.select(F.least("a", "gid").alias("a"), F.greatest("a", "gid").alias("b")).distinct()
        pairs = staged(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        if pairs.isEmpty():
            break
        tested = pairs if tested is None else tested.union(pairs)
        links = links.union(verified(pairs, docs, words, percent))
        label = staged(components(links), "label")
    # the rest: all members of a shingle's groups, and of one group, that are in different components, by pairs of tiles
    named_members = members.select("g", "rep").join(label, F.col("rep") == F.col("node"), "left").select("g", "rep", F.coalesce("component", "rep").alias("component"))
    all_rows = tokens.join(named_members, "g").select("token", "rep", "n", "pos", "component").union(inner.join(named_members.drop("g"), "rep").select("token", "rep", "n", "pos", "component"))
    tiles = F.ceil(F.col("held") / TILE)
    both = staged(_mixed(all_rows).withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("rep"), "tiles")), "mixed")
    one = both.select("token", F.col("tile").alias("x"), F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("y"), F.col("rep").alias("a"), "n", "pos", "component")
    other = both.select("token", F.explode(F.sequence(F.lit(0).cast("long"), "tile")).alias("x"), F.col("tile").alias("y"), F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("component").alias("cb"))
    pairs = one.join(other, ["token", "x", "y"]).where(F.col("component") != F.col("cb")).where("x < y or a < b").where(_possible(percent, "n", "nb", "pos", "pb"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = staged(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    if not pairs.isEmpty():
        links = links.union(verified(pairs, docs, words, percent))
        label = staged(components(links), "label")
    classes = first.join(label, first["rep"] == label["node"], "left").select("digest", F.coalesce("component", "rep").alias("c"))
    out = all_sets.select("doc_id", "n", "digest").join(classes, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"))
    if not repeated:
        return out
    # a row without shingles is where its document's other rows are
    low = staged(out.join(several, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("low")), "low")
    return out.join(low, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("low", "component_id").alias("component_id"))
