"""Media columns: payloads in tar shards, addressed by content; rows carry digest, offset and length.

Each map task writes the payloads of its own rows as 8-bit greyscale PNG members, named by digest, to tar shards in the
shared folder, each content once. Rows keep (digest, shard, offset, length); of the places that hold a content the
first one is the table's. Metadata columns come from range reads of a member's first bytes; features read it whole.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ragset.llm.common import attempt, files, new_dir, put_file, staged

WIDTH, SIGNATURE, HEADER = 576, b"\x89PNG\r\n\x1a\n", 33
SEEN = 1_000_000


def payload_of(text: bytes) -> bytes:
    """The text's bytes with bytes 255 up to a positive multiple of WIDTH."""
    return text + b"\xff" * (-len(text) % WIDTH or (0 if text else WIDTH))


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes) -> bytes:
    """A greyscale image of WIDTH columns, a byte a sample, no filters."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.concatenate([np.zeros((len(rows), 1), np.uint8), rows], axis=1)
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + _chunk(b"IEND", b"")


def decode_png(media: bytes) -> bytes:
    """The samples of such an image; a wrong checksum or size raises."""
    width, height = struct.unpack_from(">II", media, 16)
    at, data = 8, []
    while at < len(media):
        (n,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + n)[0]:
            raise ValueError("damaged image")
        if kind == b"IDAT":
            data.append(body)
        at += 12 + n
    return np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)[:, 1:].tobytes()


def tar_header(name: str, size: int) -> bytes:
    """A ustar header of a plain file, the same for the same name and size."""
    head = b"".join((name.encode().ljust(100, b"\0"), b"0000644\0", b"0000000\0" * 2, b"%011o\0" % size, b"0" * 11 + b"\0", b" " * 8, b"0", b"\0" * 100, b"ustar\0" b"00", b"\0" * 247))
    return head[:148] + b"%06o\0 " % sum(head) + head[156:]


def write_shards(docs: DataFrame, out_dir: str, shard_bytes: int = 256 << 20) -> DataFrame:
    """(doc_id, n_bytes, digest, shard, offset, length) of every row of docs; offset and length are those of the member's data.

    A null text is empty. docs needs doc_id and text; other columns are ignored.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, tag = attempt()
        fs, root = files(out_dir)
        out, done, at, shard, seen = None, None, 0, -1, {}
        for batch in batches:
            rows: list[tuple] = []
            for text in batch.column("text").to_pylist():
                payload = payload_of(text or b"")
                digest = hashlib.sha256(payload).hexdigest()
                if digest not in seen:
                    if out is None or at > shard_bytes:
                        if out is not None:
                            out.write(bytes(1024))
                            done()
                        shard, at = shard + 1, 0
                        out, done = put_file(fs, f"{root}/{worker:06d}-{shard:04d}.tar", tag)
                    media = encode_png(payload)
                    out.write(tar_header(f"{digest}.png", len(media)) + media + bytes(-len(media) % 512))
                    if len(seen) > SEEN:
                        seen.clear()
                    seen[digest] = (f"{worker:06d}-{shard:04d}.tar", at + 512, len(media))
                    at += 512 + len(media) + -len(media) % 512
                rows.append((len(text or b""), digest, *seen[digest]))
            cols = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        if out is not None:
            out.write(bytes(1024))
            done()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return staged(texts.mapInArrow(write, "doc_id long, n_bytes long, digest string, shard string, offset long, length long"), "media")


def contents(rows: DataFrame) -> DataFrame:
    """One row a content: digest and its first place."""
    place = F.min(F.struct("shard", "offset", "length")).alias("p")
    return rows.groupBy("digest").agg(place).select("digest", "p.*")


def _ranges(index: DataFrame, out_dir: str, take, columns: str) -> DataFrame:
    """index with the columns of take(a reader of (offset, size), the row), one open shard at a time."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = files(out_dir)
        name, source = None, None
        for batch in batches:
            got = []
            for row in batch.to_pylist():
                if row["shard"] != name:
                    if source is not None:
                        source.close()
                    name, source = row["shard"], fs.open_input_file(f"{root}/{row['shard']}")
                got.append(take(lambda at, size, source=source: source.read_at(size, at), row))
            yield pa.RecordBatch.from_pylist([r | g for r, g in zip(batch.to_pylist(), got)], schema=schema)
        if source is not None:
            source.close()

    arrow = {"long": pa.int64(), "string": pa.string(), "bigint": pa.int64()}
    fields = [*index.dtypes, *(c.split() for c in columns.split(", "))]
    schema = pa.schema([(n, arrow[t]) for n, t in fields])
    return index.mapInArrow(read, ", ".join(f"{n} {t}" for n, t in fields))


def with_metadata(index: DataFrame, out_dir: str) -> DataFrame:
    """index with media_bytes, width, height, bit_depth from the tar header and the image header alone."""

    def take(read, row) -> dict:
        head = read(row["offset"] - 512, 512 + HEADER)
        if head[:64].decode() != row["digest"] or head[512:520] != SIGNATURE:
            raise ValueError("no such member")
        width, height, depth = struct.unpack_from(">IIB", head, 528)
        return {"media_bytes": int(head[124:135], 8), "width": width, "height": height, "bit_depth": depth}

    return _ranges(index, out_dir, take, "media_bytes long, width long, height long, bit_depth long")


def feature(payload: bytes) -> str:
    """Mean and variance of the samples and how often each of 16 levels occurs, as text."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64)
    levels = ".".join(map(str, np.bincount(x >> 4, minlength=16)))
    return f"gray8;n={len(x)};mean={x.mean():.6f};var={x.var():.6f};levels={levels}"


def with_features(index: DataFrame, out_dir: str) -> DataFrame:
    """index with payload_bytes, payload_sha256, tail_crc32, media_sha256 and feature, of the stored bytes."""

    def take(read, row) -> dict:
        media = read(row["offset"], row["length"])
        payload = decode_png(media)
        return {
            "payload_bytes": len(payload),
            "payload_sha256": hashlib.sha256(payload).hexdigest(),
            "tail_crc32": zlib.crc32(payload[-32:]),
            "media_sha256": hashlib.sha256(media).hexdigest(),
            "feature": feature(payload),
        }

    return _ranges(index, out_dir, take, "payload_bytes long, payload_sha256 string, tail_crc32 long, media_sha256 string, feature string")


def media_columns(docs: DataFrame) -> DataFrame:
    """Every row of docs with its payload's place and what the stored bytes show.

    Rows of one text have equal values and share a place; rows with a null doc_id stay. An empty table gives no rows.
    """
    out_dir = new_dir(docs.sparkSession, "shards")
    rows = write_shards(docs, out_dir)
    index = staged(contents(rows), "contents")
    parts = max(1, index.select("shard").distinct().count()) * 2
    near = index.repartitionByRange(parts, "shard", "offset").sortWithinPartitions("shard", "offset")
    read = staged(with_features(with_metadata(near, out_dir), out_dir), "features")
    return rows.select("doc_id", "n_bytes", "digest").join(read, "digest").select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height", "shard", "offset", "length"
    )
