"""Length-delimited binary records of token ids, with a separate offset index.

Record: uint64 length, uint32 masked CRC-32C of those 8 bytes, the payload, uint32 masked CRC-32C of the payload; all
little-endian. Payload: int64 doc_id (-2^63 for null), then the ids, two bytes each where the vocabulary allows and
else four. Index: one uint64 record offset after another, so that a reader in any order can seek to record i. Files
are numbered in doc_id order.
"""

from __future__ import annotations

import functools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ragset.llm.common import attempt, files, new_dir, put_file, staged
from ragset.llm.tokens import encoder, public_path, slices

POLY, MASK_DELTA, NULL_ID = 0x82F63B78, 0xA282EAD8, -(2**63)
BLOCK = 2048


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Of the CRC register: what the byte at distance 0..7 from a word's end adds, and the effect of BLOCK zero bytes."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLY), t >> 1)
    word = [t]
    for _ in range(7):
        word.append((word[-1] >> 8) ^ t[word[-1] & 255])
    shift = [t.copy() * 0 + np.uint32(0) for _ in range(4)]
    for i in range(4):
        reg = np.arange(256, dtype=np.uint32) << np.uint32(8 * i)
        for _ in range(BLOCK):
            reg = (reg >> 8) ^ t[reg & 255]
        shift[i] = reg
    return np.stack(word), np.stack(shift)


def crc32c_many(payloads: list[bytes]) -> list[int]:
    """CRC-32C of each payload. All payloads' blocks of BLOCK bytes step through the register side by side."""
    word, shift = _tables()
    short = [i for i, p in enumerate(payloads) if len(p) < 4]
    out = [0] * len(payloads)
    for i in short:
        reg = 0xFFFFFFFF
        for b in payloads[i]:
            reg = (reg >> 8) ^ int(word[0][(reg ^ b) & 255])
        out[i] = reg ^ 0xFFFFFFFF
    long = [i for i, p in enumerate(payloads) if len(p) >= 4]
    if not long:
        return out
    # zeros in front leave the zero register alone; the first four bytes take the initial register
    counts = [-(-len(payloads[i]) // BLOCK) for i in long]
    data = b"".join(
        b"".join((bytes(c * BLOCK - len(p)), bytes(x ^ 255 for x in p[:4]), p[4:])) for c, p in zip(counts, (payloads[i] for i in long))
    )
    lanes = np.frombuffer(data, np.uint8).reshape(-1, BLOCK)
    reg = np.zeros(len(lanes), np.uint32)
    cols = np.ascontiguousarray(lanes.T)
    for at in range(0, BLOCK, 8):
        r = cols[at : at + 4] ^ reg.view(np.uint8).reshape(-1, 4).T
        reg = word[7][r[0]] ^ word[6][r[1]] ^ word[5][r[2]] ^ word[4][r[3]] ^ word[3][cols[at + 4]] ^ word[2][cols[at + 5]] ^ word[1][cols[at + 6]] ^ word[0][cols[at + 7]]
    lane = 0
    for i, c in zip(long, counts):
        total = 0
        for k in range(lane, lane + c):
            total = int(shift[0][total & 255] ^ shift[1][total >> 8 & 255] ^ shift[2][total >> 16 & 255] ^ shift[3][total >> 24]) ^ int(reg[k])
        lane += c
        out[i] = total ^ 0xFFFFFFFF
    return out


def masked(crc: int) -> int:
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payloads: list[bytes]) -> list[bytes]:
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    crcs = crc32c_many(heads + payloads)
    return [h + struct.pack("<I", masked(a)) + p + struct.pack("<I", masked(b)) for h, a, p, b in zip(heads, crcs, payloads, crcs[len(heads) :])]


def unframe(records: list[bytes]) -> list[bytes]:
    """Payloads of whole records; a wrong length or checksum raises."""
    got = [struct.unpack_from("<QI", r) for r in records]
    payloads = [r[12:-4] for r in records]
    crcs = crc32c_many([r[:8] for r in records] + payloads)
    for r, (n, head), p, a, b in zip(records, got, payloads, crcs, crcs[len(records) :]):
        if n != len(p) or head != masked(a) or struct.unpack("<I", r[-4:])[0] != masked(b):
            raise ValueError("damaged record")
    return payloads


def write_records(docs: DataFrame, out_dir: str, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Writes out_dir/part-*.rec and .idx in ascending doc_id order; returns one row a file: file, part, records, ids.

    A null text is the end id alone; null doc_ids come first; rows of one doc_id are ordered by text. Without rows
    there are no files. A task that runs again writes its whole files anew under the same names.
    """
    path, end = tokenizer or public_path("word_bpe_49k.json"), int(end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tag = attempt()
        fs, root = files(out_dir)
        name, out, enc = f"{root}/part-{part:06d}", None, encoder(path)
        wide = max(enc.tokenizer.get_vocab_size(with_added_tokens=True), end + 1) > 65536
        offsets, at, n_ids = [], 0, 0
        for batch in batches:
            for a, b in slices(batch.num_rows, 256):
                piece = batch.slice(a, b - a)
                texts = [np.frombuffer(x, "<u4") for x in enc.encode(piece.column("text").to_pylist())]
                payloads = []
                for doc, ids in zip(piece.column("doc_id").to_pylist(), texts, strict=True):
                    payloads.append(struct.pack("<q", NULL_ID if doc is None else doc) + np.append(ids, np.uint32(end)).astype("<u4" if wide else "<u2").tobytes())
                    n_ids += len(ids) + 1
                if out is None:
                    out, done = put_file(fs, f"{name}.rec", tag)
                for r in frame(payloads):
                    out.write(r)
                    offsets.append(at)
                    at += len(r)
        if out is not None:
            index, index_done = put_file(fs, f"{name}.idx", tag)
            index.write(struct.pack("<QQ", 4 if wide else 2, at) + np.array(offsets, "<u8").tobytes())
            index_done()
            done()
            yield pa.RecordBatch.from_pydict({"file": [f"part-{part:06d}"], "part": pa.array([part], pa.int64()), "records": pa.array([len(offsets)], pa.int64()), "ids": pa.array([n_ids], pa.int64())})

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(write, "file string, part long, records long, ids long"), "records")


def read_records(written: DataFrame, out_dir: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """(file, part, nth, before, doc_id, ids) from the files, every checksum tested; ids are little-endian uint32, before counts the file's ids in front."""
    count = written.count()  # one row a file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = files(out_dir)
        for batch in batches:
            for name, part in zip(batch.column("file").to_pylist(), batch.column("part").to_pylist()):
                with fs.open_input_stream(f"{root}/{name}.idx") as f:
                    index = f.read()
                width, size = struct.unpack_from("<QQ", index)
                bounds = np.append(np.frombuffer(index, "<u8", offset=16), np.uint64(size)).astype(np.int64)
                with fs.open_input_file(f"{root}/{name}.rec") as f:
                    lo, before = 0, 0
                    while lo < len(bounds) - 1:
                        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + batch_bytes, "right")) - 1)
                        block = f.read_at(int(bounds[hi] - bounds[lo]), int(bounds[lo]))
                        at = bounds[lo : hi + 1] - bounds[lo]
                        got = unframe([block[at[k] : at[k + 1]] for k in range(hi - lo)])
                        lengths = np.array([len(p) // width - 8 // width for p in got])
                        starts = before + np.cumsum(lengths) - lengths
                        before += int(lengths.sum())
                        docs = [struct.unpack_from("<q", p)[0] for p in got]
                        yield pa.RecordBatch.from_pydict(
                            {
                                "file": [name] * len(got),
                                "part": pa.array([part] * len(got), pa.int64()),
                                "nth": pa.array(range(lo, hi), pa.int64()),
                                "before": pa.array(starts, pa.int64()),
                                "doc_id": pa.array([None if d == NULL_ID else d for d in docs], pa.int64()),
                                "ids": pa.array([np.frombuffer(p, f"<u{width}", offset=8).astype("<u4").tobytes() for p in got], pa.binary()),
                            }
                        )
                        lo = hi

    return written.select("file", "part").repartition(max(1, count)).mapInArrow(read, "file string, part long, nth long, before long, doc_id long, ids binary")


def token_records(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Writes the record files to the shared folder, reads them back, and returns doc_id, start, n_tokens, ids_crc32 of every record."""
    out_dir = new_dir(docs.sparkSession, "records")
    written = write_records(docs, out_dir, tokenizer, end_id)
    first = written.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("first"))  # one row a file
    back = read_records(written, out_dir).select("part", "before", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return back.join(F.broadcast(first), "part").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
