"""Token ids as flat binary files with 64-bit document offsets.

A folder holds, per partition of the documents in ascending doc_id order,

* ``part-N.tokens``   unsigned ids, little-endian, 16 bit if the vocabulary allows, else 32
* ``part-N.offsets``  signed 64-bit, n + 1 of them: where each document starts in that file
* ``part-N.docs``     signed 64-bit doc_ids; those of the first ``null_docs`` are no ids (NULL)

and ``manifest.json`` with the id width and, per partition, its counts and the ids and
documents before it: the prefix sums of the counts. A document's place in the whole is
the base of its partition plus its offset, so files are written in one pass, and any of
them can be memory-mapped alone.

A task writes under a name of its own and renames at the end, so a repeated task leaves
whole files. Files are written with Arrow's file systems into the shared folder.

Defined cases: a NULL or empty text is a document of the end id alone; NULL doc_ids come
first; rows with the same doc_id follow each other in order of their text; an empty table
gives a manifest without documents; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.common import has_columns, ship_package, shuffle_partitions
from stockflow.llm.encoding import encoder

_STATS = pa.schema(
    [
        ("part", pa.int64()),
        ("first_doc", pa.int64()),
        ("null_docs", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
    ]
)
_STATS_DDL = "part long, first_doc long, null_docs long, n_docs long, n_tokens long"


def _files(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, vocabulary_size: int) -> list[dict]:
    """Write the files of all documents; returns the manifest's partitions, in order."""
    spark = docs.sparkSession
    ship_package(spark)
    width = 2 if max(vocabulary_size - 1, end_id) < 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        files, root = _files(folder)
        files.create_dir(root, recursive=True)
        attempt = uuid.uuid4().hex
        tokenizer = encoder(vocabulary)
        ends, ids, nulls = [0], [], 0
        with files.open_output_stream(f"{root}/.{attempt}.tokens") as out:
            for batch in batches:
                nulls += batch.column(0).null_count
                ids += batch.column(0).fill_null(0).to_pylist()
                for tokens, offsets in tokenizer.encode(batch.column(1)):
                    # the end id goes in after each document
                    with_end = np.insert(tokens, offsets[1:], end_id)
                    out.write(with_end.astype(f"<u{width}").tobytes())
                    ends += (ends[-1] + offsets[1:] + np.arange(1, len(offsets))).tolist()
        if not ids:
            files.delete_file(f"{root}/.{attempt}.tokens")
            return
        for kind, values in (("offsets", ends), ("docs", ids)):
            with files.open_output_stream(f"{root}/.{attempt}.{kind}") as out:
                out.write(np.array(values, "<i8").tobytes())
        for kind in ("tokens", "offsets", "docs"):
            files.move(f"{root}/.{attempt}.{kind}", f"{root}/part-{part:05d}.{kind}")
        first = ids[nulls] if nulls < len(ids) else None
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "first_doc": first, "null_docs": nulls, "n_docs": len(ids), "n_tokens": ends[-1]}], _STATS
        )

    in_order = (
        has_columns(docs, "doc_id", "text")
        .repartitionByRange(shuffle_partitions(spark), "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    # one row per partition; range partitions are numbered in order
    parts = [row.asDict() for row in in_order.mapInArrow(write, _STATS_DDL).collect()]
    parts.sort(key=lambda one: one["part"])
    base_docs = base_tokens = 0
    for one in parts:
        one |= {"base_docs": base_docs, "base_tokens": base_tokens}
        base_docs += one["n_docs"]
        base_tokens += one["n_tokens"]
    files, root = _files(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps({"width": width, "parts": parts}).encode())
    return parts


def _mapped(files, path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is local."""
    from pyarrow import fs

    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read_buffer(), kind)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""
    ship_package(spark)
    files, root = _files(folder)
    with files.open_input_stream(f"{root}/manifest.json") as source:
        manifest = json.loads(source.read())
    width = manifest["width"]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _files(folder)
        for batch in batches:
            for one in batch.to_pylist():
                path = f"{root}/part-{one['part']:05d}"
                tokens = _mapped(files, f"{path}.tokens", f"<u{width}")
                offsets = _mapped(files, f"{path}.offsets", "<i8")
                ids = pa.array(_mapped(files, f"{path}.docs", "<i8"), mask=np.arange(one["n_docs"]) < one["null_docs"])
                crcs = [
                    zlib.crc32(tokens[a:b].astype("<u4").tobytes())
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(one["base_tokens"] + offsets[:-1]), pa.array(np.diff(offsets)), pa.array(crcs, pa.int64())],
                    schema=schema,
                )

    parts = [(one["part"], one["n_docs"], one["null_docs"], one["base_tokens"]) for one in manifest["parts"]]
    rows = spark.createDataFrame(parts, "part long, n_docs long, null_docs long, base_tokens long")
    return rows.repartition(max(1, len(parts))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def documents_ids(folder: str, part: int, which: int) -> np.ndarray:
    """The ids of document ``which`` of a partition: for training loaders."""
    files, root = _files(folder)
    with files.open_input_stream(f"{root}/manifest.json") as source:
        width = json.loads(source.read())["width"]
    offsets = _mapped(files, f"{root}/part-{part:05d}.offsets", "<i8")
    return _mapped(files, f"{root}/part-{part:05d}.tokens", f"<u{width}")[offsets[which] : offsets[which + 1]]
