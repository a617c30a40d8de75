"""Token ids of a corpus as files of 64-bit words, written and read through a Spark data source.

The texts are dealt by ranges of ids and sorted. Each task encodes its range, closes every
document with an end id, codes it in blocks (see ``simple8b``) and writes files of them;
the folder's index, written last and at once, lists the files of successful tasks with
the number of ids before each. A task that is lost and
run again leaves a file that no index names. A file holds the ids and lengths of its
documents, where each block's words and escapes end, then the words and the escapes, so
any run of blocks is decoded as one array.

Null and empty texts hold the end id alone. Rows are in ascending order of ``doc_id``,
null ids first, rows that share an id by their content; each keeps a place of its own. An
empty table gives an index without files. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from feedlake.llm import simple8b
from feedlake.llm.tokens import TokenIds, tokenizer_path

END_ID = 2
#: Ids of a block, of a file (a longer document has one to itself) and of a decoded batch, about.
BLOCK, FILE_IDS, BATCH_IDS = 4096, 8_000_000, 500_000
#: Texts turned into Python strings at a time.
SLICE = 256
#: The start of every file, and the name of a folder's index.
MAGIC, INDEX = b"S8BTOK01", "index.json"
CODED = "doc_id bigint, n_tokens bigint, words binary, word_ends binary, escapes binary, escape_ends binary"
CODED_NAMES = [x.split()[0] for x in CODED.split(", ")]
CODED_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
DECODED = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
DECODED_NAMES = [x.split()[0] for x in DECODED.split(", ")]


def _blocks(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the blocks of documents that stand in a row, and the number of blocks before each document's end."""
    per_doc = -(-lengths // BLOCK)
    last = np.cumsum(per_doc)
    sizes = np.full(int(last[-1]) if len(last) else 0, BLOCK, dtype=np.int64)
    some = lengths > 0
    sizes[last[some] - 1] = lengths[some] - (per_doc[some] - 1) * BLOCK
    return np.cumsum(sizes), last


def coded(doc_ids: list, documents: list[bytes]) -> pa.RecordBatch:
    """Rows :data:`CODED` of documents given as unsigned little-endian 32-bit ids."""
    lengths = np.array([len(d) // 4 for d in documents], dtype=np.int64)
    ends, last = _blocks(lengths)
    words, word_ends, escapes, escape_ends = simple8b.encode(np.frombuffer(b"".join(documents), "<u4"), ends)
    first = np.concatenate([[0], last[:-1]])
    word_ends, escape_ends = np.append(0, word_ends), np.append(0, escape_ends)
    rows = []
    for doc_id, n, a, b in zip(doc_ids, lengths.tolist(), first.tolist(), last.tolist()):
        w, e = word_ends[a : b + 1], escape_ends[a : b + 1]
        own = words[w[0] : w[-1]].tobytes(), (w[1:] - w[0]).astype("<i8").tobytes()
        rows.append((doc_id, n, *own, escapes[e[0] : e[-1]].tobytes(), (e[1:] - e[0]).astype("<i8").tobytes()))
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), CODED_TYPES)], CODED_NAMES)


def coded_documents(texts: DataFrame, path: str, end_id: int) -> DataFrame:
    """:data:`CODED` of ``doc_id, text``."""
    end = struct.pack("<I", end_id)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenIds(path)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                ids, own = (c.slice(i, SLICE).to_pylist() for c in batch.columns)
                yield coded(ids, [encoder.encode(t) + end for t in own])

    return texts.mapInArrow(rows, CODED)


def file_bytes(rows: list[tuple]) -> bytes:
    """One file of rows :data:`CODED`."""
    ids, lengths, words, word_ends, escapes, escape_ends = zip(*rows)

    def ends(parts: tuple[bytes, ...], contents: tuple[bytes, ...], width: int) -> bytes:
        """Ends within the file, from ends within each document."""
        before = np.cumsum([0, *(len(c) // width for c in contents)])
        return b"".join((np.frombuffer(p, "<i8") + b).tobytes() for p, b in zip(parts, before.tolist()))

    counts = len(ids), sum(len(p) // 8 for p in word_ends), sum(map(len, words)) // 8, sum(map(len, escapes)) // 4
    head = [
        np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
        np.array([i is not None for i in ids], "u1").tobytes(),
        np.array(lengths, "<i8").tobytes(),
        ends(word_ends, words, 8),
        ends(escape_ends, escapes, 4),
    ]
    return b"".join((MAGIC, struct.pack("<4q", *counts), *head, *words, *escapes))


def documents_of(data: bytes, start: int) -> Iterator[pa.RecordBatch]:
    """Rows :data:`DECODED` of a file; ``start`` is the number of ids before it."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    n_docs, n_blocks, n_words, n_escapes = struct.unpack_from("<4q", data, len(MAGIC))
    at = len(MAGIC) + 32

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, n, at)
        at += found.nbytes
        return found

    ids, known, lengths = take("<i8", n_docs), take("u1", n_docs), take("<i8", n_docs)
    word_ends, escape_ends = np.append(0, take("<i8", n_blocks)), np.append(0, take("<i8", n_blocks))
    words, escapes = take("<u8", n_words), take("<u4", n_escapes)
    ends, last = _blocks(lengths)
    doc_ends = np.cumsum(lengths)
    doc = 0
    while doc < n_docs:
        before = int(doc_ends[doc] - lengths[doc])
        upto = max(doc + 1, int(np.searchsorted(doc_ends, before + BATCH_IDS, side="right")))
        a, b = (int(last[doc - 1]) if doc else 0), int(last[upto - 1])
        w, e = word_ends[a : b + 1], escape_ends[a : b + 1]
        tokens = simple8b.decode(words[w[0] : w[-1]], w[1:] - w[0], ends[a:b] - before, escapes[e[0] : e[-1]])
        own = slice(doc, upto)
        cuts = np.concatenate([[before], doc_ends[own]]) - before
        buffers = [None, pa.py_buffer((4 * cuts).astype("<i4").tobytes()), pa.py_buffer(tokens.astype("<u4").tobytes())]
        columns = [
            pa.array(ids[own], pa.int64(), mask=known[own] == 0),
            pa.array(start + before + cuts[:-1]),
            pa.array(lengths[own]),
            pa.Array.from_buffers(pa.binary(), upto - doc, buffers),
        ]
        yield pa.record_batch(columns, DECODED_NAMES)
        doc = upto


def _store(path: str):
    """The file system of a path, and the path within it."""
    from pyarrow import fs

    scheme, found, rest = path.partition("://")
    if not found:
        return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:"))
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def _put(path: str, data: bytes) -> None:
    store, at = _store(path)
    with store.open_output_stream(at) as out:
        out.write(data)


def _get(path: str) -> bytes:
    store, at = _store(path)
    with store.open_input_file(at) as f:
        return f.read()


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: name, documents, ids."""

    part: int
    files: list[tuple[str, int, int]]


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        files, rows, held = [], [], 0

        def close() -> None:
            nonlocal rows, held
            name = f"part-{part:06d}-{len(files):04d}-{attempt}.s8b"
            _put(f"{self.path}/{name}", file_bytes(rows))
            files.append((name, len(rows), held))
            rows, held = [], 0

        for batch in iterator:
            for row in zip(*(batch.column(n).to_pylist() for n in CODED_NAMES)):
                if rows and held + row[1] > FILE_IDS:
                    close()
                rows.append(row)
                held += row[1]
        if rows:
            close()
        return Written(part, files)

    def commit(self, messages: list[Written | None]) -> None:
        index, start = [], 0
        for message in sorted((m for m in messages if m is not None), key=lambda m: m.part):
            for name, docs, ids in message.files:
                index.append({"file": name, "documents": docs, "start": start, "ids": ids})
                start += ids
        _put(f"{self.path}/{INDEX}", json.dumps({"ids": start, "files": index}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files without an index are never read."""


@dataclass
class _File(InputPartition):
    name: str
    start: int


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        index = json.loads(_get(f"{self.path}/{INDEX}"))
        return [_File(f["file"], f["start"]) for f in index["files"]]

    def read(self, partition: _File | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:
            yield from documents_of(_get(f"{self.path}/{partition.name}"), partition.start)


class TokenFiles(DataSource):
    """``format("token_files")``: takes :data:`CODED` in the order it is to be kept, gives :data:`DECODED`."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> str:
        return DECODED

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"].rstrip("/"))

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"].rstrip("/"))


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode all texts into a new folder of token files in ascending order of ids."""
    spark = docs.sparkSession
    spark.dataSource.register(TokenFiles)
    store, at = _store(path)
    store.create_dir(at, recursive=True)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # One id may be that of very many rows; their content splits them. Only these two are sampled for the ranges.
    order = ["doc_id", F.xxhash64("text")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    coded = coded_documents(texts, tokenizer_path(tokenizer), end_id)
    coded.write.format("token_files").mode("append").save(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` per document; ``ids`` are unsigned little-endian 32-bit numbers."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format("token_files").load(path)
