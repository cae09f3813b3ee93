"""Token ids of whole documents in Simple-8b files.

A file: magic and block length; the words; then the index (first word of each block, places of escaped words, and for each
document its id, whether it has one, its first id's place in the file and its number of ids); then the counts and the magic
again. Block offsets make any document readable without what is before it, in bounded memory.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import simple8b
from .commit import commit, manifest, open_fs, temporary
from .vocab import hf_encoder, single_threaded
from .workspace import partitions

MAGIC = b"S8BTOK01"
_TAIL = struct.Struct("<5Q8s")
#: Blocks coded at once; ids, and documents, from which a file is closed after a document.
CHUNK, ROLL, ROLL_DOCS = 256, 1 << 26, 1 << 22
_FILES = "pid int, roll int, tmp string, n_docs long, n_tokens long, n_words long"
_MANIFEST = "name string, start long, n_docs long, n_tokens long, n_words long"


class Writer:
    """Writes one file; holds one chunk of ids and the index, 25 bytes a document."""

    def __init__(self, sink, block: int = simple8b.BLOCK):
        self._sink, self._block = sink, block
        self._held: list[np.ndarray] = []
        self._n_held = self.n_tokens = self.n_words = 0
        self._offsets, self._escaped = [], []
        self._ids, self._known, self._starts, self._counts = array("q"), bytearray(), array("Q"), array("Q")
        sink.write(MAGIC + struct.pack("<Q", block))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._ids.append(doc_id or 0)
        self._known.append(doc_id is not None)
        self._starts.append(self.n_tokens)
        self._counts.append(len(ids))
        self.n_tokens += len(ids)
        self._held.append(ids)
        self._n_held += len(ids)
        chunk = CHUNK * self._block
        if self._n_held >= chunk:
            ids = np.concatenate(self._held)
            whole = len(ids) // chunk * chunk
            for i in range(0, whole, chunk):
                self._code(ids[i : i + chunk])
            self._held, self._n_held = [ids[whole:].copy()], len(ids) - whole

    def _code(self, ids: np.ndarray) -> None:
        words, offsets, escaped = simple8b.encode(ids, self._block)
        self._offsets.append(offsets[:-1] + self.n_words)
        self._escaped.append(escaped + self.n_words)
        self._sink.write(words.astype("<u8").tobytes())
        self.n_words += len(words)

    @property
    def n_docs(self) -> int:
        return len(self._ids)

    def close(self) -> None:
        if self._n_held:
            self._code(np.concatenate(self._held))
        offsets = np.concatenate([*self._offsets, [self.n_words]]).astype("<u8")
        escaped = np.concatenate([*self._escaped, []]).astype("<u8")
        for x, kind in ((offsets, "<u8"), (escaped, "<u8"), (self._ids, "<i8"), (self._known, "u1"), (self._starts, "<u8"), (self._counts, "<u8")):
            self._sink.write(np.asarray(x, kind).tobytes())
        self._sink.write(_TAIL.pack(len(offsets), len(escaped), self.n_docs, self.n_tokens, self.n_words, MAGIC))
        self._sink.close()


def read_documents(source) -> Iterator[tuple[int | None, int, int, Iterator[np.ndarray]]]:
    """(doc id, first place, number of ids, parts of its ids) of each document of an open file; a part is read when asked for."""
    size = source.size()
    source.seek(size - _TAIL.size)
    n_offsets, n_escaped, n_docs, n_tokens, n_words, magic = _TAIL.unpack(source.read(_TAIL.size))
    source.seek(0)
    head = source.read(16)
    if magic != MAGIC or head[:8] != MAGIC:
        raise ValueError("not a token file")
    block = struct.unpack("<Q", head[8:])[0]
    source.seek(16 + 8 * n_words)
    offsets, escaped = (np.frombuffer(source.read(8 * n), "<u8").astype(np.int64) for n in (n_offsets, n_escaped))
    ids, known, starts, counts = (np.frombuffer(source.read(n_docs * w), kind) for w, kind in ((8, "<i8"), (1, "u1"), (8, "<u8"), (8, "<u8")))
    held: tuple[int, np.ndarray] = (-1, np.zeros(0, np.uint32))

    def chunk(k: int) -> np.ndarray:
        nonlocal held
        if held[0] != k:
            a, b = k * CHUNK, min((k + 1) * CHUNK, n_offsets - 1)
            source.seek(16 + 8 * int(offsets[a]))
            words = np.frombuffer(source.read(8 * int(offsets[b] - offsets[a])), "<u8").astype(np.uint64)
            inner = escaped[(escaped >= offsets[a]) & (escaped < offsets[b])] - offsets[a]
            held = k, simple8b.decode(words, offsets[a : b + 1] - offsets[a], inner, min(b * block, n_tokens) - a * block, block).astype("<u4")
        return held[1]

    def parts(start: int, n: int) -> Iterator[np.ndarray]:
        span = CHUNK * block
        while n:
            k, at = divmod(start, span)
            part = chunk(k)[at : at + n]
            yield part
            start, n = start + len(part), n - len(part)

    for i in range(n_docs):
        start, n = int(starts[i]), int(counts[i])
        yield (int(ids[i]) if known[i] else None), start, n, parts(start, n)


def write_tokens(docs: DataFrame, root: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, roll: int = ROLL, roll_docs: int = ROLL_DOCS) -> None:
    """Encode every whole text with ``tokenizer`` (a byte-level file of the tokenizers library) and write the ids below ``root``, in ascending order of id.

    One shuffle range-partitions the texts by id; a task sorts its range, encodes it and writes it as a stream, so a task holds one batch
    of texts and one chunk of ids. A file closes after the document that brings it to ``roll`` ids or ``roll_docs`` documents. Lost tasks are run again
    under other temporary names.

    Defined cases: a null text has the end id alone; rows without an id come first; rows with equal ids stay together, in the order of their texts; an empty table gives a manifest without files. Other columns aren't read.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        single_threaded()
        encoder, end, pid = hf_encoder(tokenizer), np.array([end_id], np.uint32), TaskContext.get().partitionId()
        done, out, tmp = [], None, ""
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None:
                    tmp = temporary(root, ".s8b")
                    fs, path = open_fs(tmp)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out = Writer(fs.open_output_stream(path))
                text = text.as_py()
                out.add(doc_id, np.append(encoder.encode(text), end) if text else end)
                if out.n_tokens >= roll or out.n_docs >= roll_docs:
                    out.close()
                    done.append((pid, len(done), tmp, out.n_docs, out.n_tokens, out.n_words))
                    out = None
        if out is not None:
            out.close()
            done.append((pid, len(done), tmp, out.n_docs, out.n_tokens, out.n_words))
        names = ["pid", "roll", "tmp", "n_docs", "n_tokens", "n_words"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=names)

    ordered = docs.select(F.col(id_col).cast("long"), F.col(text_col)).repartitionByRange(partitions(spark), F.col(id_col).asc_nulls_first()).sortWithinPartitions(F.col(id_col).asc_nulls_first(), text_col)
    files, start = [], 0
    for x in sorted(ordered.mapInArrow(write, _FILES).collect()):  # a row for each file
        files.append({"name": f"tokens-{x.pid:06d}-{x.roll:04d}.s8b", "tmp": x.tmp, "start": start, "n_docs": x.n_docs, "n_tokens": x.n_tokens, "n_words": x.n_words})
        start += x.n_tokens
    commit(spark, root, files)


def read_tokens(spark: SparkSession, root: str, *, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document of the files, and its ids if asked for.

    A task reads a file chunk by chunk; only ``with_ids`` holds a document's ids together.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                fs, path = open_fs(f"{root}/{f['name']}")
                rows: list[tuple] = []
                with fs.open_input_file(path) as source:
                    for doc_id, start, n, parts in read_documents(source):
                        crc, ids = 0, []
                        for part in parts:
                            crc = zlib.crc32(part.tobytes(), crc)
                            if with_ids:
                                ids.extend(part.tolist())
                        rows.append((doc_id, f["start"] + start, n, crc, *([ids] if with_ids else [])))
                        if len(rows) >= (256 if with_ids else 8192):
                            yield _batch(rows, with_ids)
                            rows = []
                if rows:
                    yield _batch(rows, with_ids)

    return manifest(spark, root, _MANIFEST).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def _batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names[: len(kinds)])
