"""Token-ID output as Parquet list columns (operator 7).

Documents are range-partitioned by id, encoded, and written in ascending id
order: one file a partition, small row groups, dictionary-encoded (else
delta-encoded) ids, page indexes.  ``doc_id``, ``n_tokens`` and the position
columns can be read without the ids, and a doc_id range reads only its pages.

Columns of the files: ``part`` (rank of the partition in id order),
``part_start`` (ids of the partition before the document), ``doc_id``,
``n_tokens`` (with the end id) and ``ids``.

Ids are those of the library's own call, ``encode(text,
add_special_tokens=False)``: strings of the tokenizer's added tokens (such as
``<|endoftext|>``) inside a text become their ids.

Defined results: a null or empty text is written as the end id alone; null ids
sort first; rows with equal ids are ordered by text (null first), equal rows
keep one place each; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardforge.llm.bpe import SliceCache, encode_chunk
from cardforge.llm.common import chunks, text_batches

#: options of the Parquet writer: row groups, pages, encodings (fixed values)
FILE_OPTIONS = {
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.writer.version": "PARQUET_2_0",
    "compression": "zstd",
}

#: text that is encoded at a time, and slices that a worker keeps: more of both than
#: for an encoder of our own, as the library's calls cost more
CHUNK_BYTES = 8 << 20
CACHE_SLICES = 300_000
#: up to so many files their offsets are broadcast, beyond that joined by a shuffle
BROADCAST_FILES = 100_000


@functools.lru_cache(maxsize=2)
def library(tokenizer_path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path)


def _spec(tokenizer_path: str) -> dict:
    with open(tokenizer_path, encoding="utf-8") as file:
        return json.load(file)


@functools.lru_cache(maxsize=2)
def added_tokens(tokenizer_path: str) -> tuple[str, dict[str, int], bool]:
    """A pattern of the added tokens (longest first, '' for none), their ids, and
    whether texts can be cut at them as they stand."""
    tokens = [t for t in _spec(tokenizer_path).get("added_tokens") or [] if t["content"]]
    plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens)
    names = sorted((t["content"] for t in tokens), key=len, reverse=True)
    return "|".join(map(re.escape, names)), {t["content"]: t["id"] for t in tokens}, plain


def encode_texts(texts: pa.Array, tokenizer_path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of a chunk of texts, flat, and the bounds of each text's ids."""
    cache, (pattern, of, plain) = slice_cache(tokenizer_path), added_tokens(tokenizer_path)
    texts = pc.fill_null(texts, "")
    holds = np.asarray(pc.match_substring_regex(texts, pattern)) if pattern else np.zeros(len(texts), dtype=bool)
    if not holds.any():
        return encode_chunk(texts, cache)
    pieces, after, last = [], [], []  # pieces between added tokens, ids that follow each, pieces up to each text's end
    for text, cut in zip(texts.to_pylist(), holds):
        if not cut:
            pieces.append(text)
            after.append([])
        elif plain:
            parts = re.split(f"({pattern})", text)
            pieces += parts[::2]
            after += [[of[x]] for x in parts[1::2]] + [[]]
        else:  # tokens that take spaces or whole words: the library's call itself
            pieces.append("")
            after.append(library(tokenizer_path).encode(text, add_special_tokens=False).ids)
        last.append(len(pieces))
    ids, bounds = encode_chunk(pa.array(pieces, type=pa.large_string()), cache)
    sizes = [len(x) for x in after]
    ids = np.insert(ids, np.repeat(bounds[1:], sizes), [x for part in after for x in part])
    return ids, (bounds + np.concatenate(([0], np.cumsum(sizes))))[[0, *last]]


def byte_letters() -> str:
    """The letters that stand for the 256 bytes in a byte-level vocabulary: printable
    bytes for themselves, the others in order for those from U+0100 (a fixed rule)."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in printable]
    return "".join(chr(b) if b in printable else chr(256 + hidden.index(b)) for b in range(256))


@functools.lru_cache(maxsize=2)
def slice_cache(tokenizer_path: str) -> SliceCache:
    """Ids of pre-token slices by the library's model."""
    spec, tokenizer = _spec(tokenizer_path), library(tokenizer_path)
    cutter = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not cutter.get("use_regex", True):
        raise ValueError("a byte-level tokenizer without normalizer and added spaces")
    model, letters = tokenizer.model, byte_letters()

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [[t.id for t in model.tokenize(str(p, "latin-1").translate(letters))] for p in pieces]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(lengths.sum())), lengths

    return SliceCache(encode, CACHE_SLICES)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", options: dict[str, str] | None = None) -> None:
    text_batches(docs.sparkSession)
    key = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi in chunks(batch.column(1), CHUNK_BYTES):
                ids, bounds = encode_texts(batch.column(1).slice(lo, hi - lo), tokenizer_path)
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, part, dtype=np.int32)), pa.array(done + bounds[:-1]),
                     batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    ["part", "part_start", "doc_id", "n_tokens", "ids"])
                done += int(bounds[-1])

    (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, f"part int, part_start long, doc_id {key}, n_tokens long, ids array<int>")
     .write.options(**{**FILE_OPTIONS, **(options or {})}).parquet(path))


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens[, ids])``: ``start`` counts the ids of all
    documents before.  Without ``ids`` only the small columns are read."""
    files = spark.read.parquet(path)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # one row a file: a running sum over files
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    if len(files.inputFiles()) <= BROADCAST_FILES:  # a row of 16 bytes a file
        before = F.broadcast(before)
    return files.join(before, "part").select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens",
                                             *(["ids"] if ids else []))


def crc_of_ids(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of ids as little-endian
    unsigned 32-bit integers."""
    key = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            flat = np.asarray(lists.flatten()).astype("<u4")
            ends = np.concatenate(([0], np.cumsum(np.asarray(pc.list_value_length(lists)))))
            crcs = [zlib.crc32(flat[lo:hi].tobytes()) for lo, hi in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(crcs, type=pa.int64())],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(run, f"doc_id {key}, start long, n_tokens long, ids_crc32 long")
