"""Token files: Parquet lists of token ids with dictionary and delta encoding and page indexes.

Documents are written in ascending key order, one row each: ``key``, ``shard`` (number of the
file), ``start`` (ids of the shard's documents before it), ``n_tokens`` and ``ids``. Ids are
dictionary-encoded, keys, starts and counts delta-encoded; row groups and pages are small enough
for a reader to fetch a few documents, and a reader of the counts never touches the ids.

Defined results: a null text encodes like an empty one, which leaves the end id alone; null keys
come first; rows with equal keys are ordered by their texts; an empty table gives an empty result;
columns other than the key and the text are neither read nor written.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import worker
from textloom.plans.session import small_side

#: Words and tokens that a worker remembers before it starts anew.
CACHE_WORDS, CACHE_TOKENS = 1_200_000, 6_000_000
#: Bytes of a row group and of a page.
ROW_GROUP, PAGE = 16 << 20, 256 << 10


class _Codes(dict):
    """A number for each word; a word not seen before gets the next one and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class WordEncoder:
    """Encodes through the tokenizers library, each distinct run between white space once.

    Valid for tokenizers whose words never cross white space and which drop it.
    """

    def __init__(self, content: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.code = _Codes()
        self.start, self.count, self.flat = worker.Growing(np.int64), worker.Growing(np.int64), worker.Growing(np.int32)

    def _ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of words, and their counts, from the tokenizer."""
        flat, count = [np.zeros(0, np.int32)], []
        for k in range(0, len(words), 10_000):
            found = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words[k : k + 10_000]], add_special_tokens=False)]
            count += map(len, found)
            flat.append(np.fromiter(chain.from_iterable(found), np.int32))
        return np.concatenate(flat), np.array(count, dtype=np.int64)

    def _ids_of_plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As above for words of ASCII letters. They are cut into no parts, so that each ends at its one closing
        token: many go to the tokenizer as one text, which spares an object for each."""
        flat, count = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), 10_000):
            part = words[k : k + 10_000]
            lines = [b" ".join(part[i : i + 20]).decode() for i in range(0, len(part), 20)]
            ids = np.fromiter(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)), np.int32)
            ends = np.flatnonzero(self.closing[ids])
            if len(ends) != len(part):
                raise ValueError("the tokenizer cuts words of letters")
            flat.append(ids)
            count.append(np.diff(ends, prepend=-1))
        return np.concatenate(flat), np.concatenate(count)

    def _learn(self) -> None:
        """Ids of the words that have a code but no ids yet.

        The tokenizer lower-cases, and it cuts before a full stop or comma that follows an ASCII
        letter or digit, so such words share the ids of what stands before; a word with "<|" may
        be a special token and goes as it is.
        """
        code, new, first = self.code, self.code.new, len(self.start)
        own: list[int] = []  # words that the tokenizer gets
        shared: list[tuple[int, int]] = []  # a word and the one in lower case
        closed: list[tuple[int, int, int]] = []  # a word, what stands before its mark, and the mark
        # Words that others need join the list while it is read.
        for i, w in enumerate(new, first):
            if b"<|" in w:
                own.append(i)
            elif w[-1:] in (b".", b",") and w[-2:-1].isalnum():
                closed.append((i, code[w[:-1].lower()], code[w[-1:]]))
            elif (low := w.lower()) == w:
                own.append(i)
            else:
                shared.append((i, code[low]))
        none = np.zeros(len(new), dtype=np.int64)
        self.start.append(none)
        self.count.append(none)
        start, count = self.start[:], self.count[:]
        plain = [i for i in own if new[i - first].isalpha()]  # of bytes: ASCII letters alone
        rest = [i for i in own if not new[i - first].isalpha()]
        for some, get in ((plain, self._ids_of_plain), (rest, self._ids)):
            flat, width = get([new[i - first] for i in some])
            start[some], count[some] = len(self.flat) + np.cumsum(width) - width, width
            self.flat.append(flat)
        if shared:
            at, low = np.array(shared).T
            start[at], count[at] = start[low], count[low]
        if closed:
            parts = np.array(closed)
            both = parts[:, 1:].ravel()
            width = count[both]
            total = width.reshape(-1, 2).sum(axis=1)
            at = np.repeat(start[both] - np.cumsum(width) + width, width) + np.arange(int(width.sum()))
            start[parts[:, 0]], count[parts[:, 0]] = len(self.flat) + np.cumsum(total) - total, total
            self.flat.append(self.flat[at])
        code.new = []

    def encode(self, rows: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, each closed by the end id, and the number of ids of each."""
        if len(self.start) > CACHE_WORDS or len(self.flat) > CACHE_TOKENS:
            self._forget()
        cut = [text.split() for text in rows]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        code = np.fromiter(map(self.code.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        if self.code.new:
            self._learn()
        width = self.count[code]
        sums = np.concatenate([[0], np.cumsum(width)])
        last = np.cumsum(sizes)
        counts = sums[last] - sums[last - sizes]
        at = np.repeat(self.start[code] - sums[:-1], width) + np.arange(int(width.sum()))
        ids = np.insert(self.flat[at], np.cumsum(counts), end_id) if len(rows) else self.flat[at]
        return ids, counts + 1


def write(df: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text and write the files in ascending order of ``key``."""
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    sent = df.sparkSession.sparkContext.broadcast(content)
    name = ("words", hashlib.sha256(content.encode()).hexdigest())
    schema = T.StructType([
        T.StructField("key", df.schema[key].dataType), T.StructField("shard", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker.kept(name, lambda: WordEncoder(sent.value))
        shard, start = TaskContext.get().partitionId(), 0
        for batch in worker.slices(batches, "text"):
            ids, counts = encoder.encode(worker.texts(batch, "text"), end_id)
            starts = start + np.cumsum(counts) - counts
            start += int(counts.sum())
            shards = pa.array(np.full(len(counts), shard, dtype=np.int32))
            columns = [batch.column("key"), shards, pa.array(starts), pa.array(counts), worker.lists(ids, counts, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    encodings = {f"parquet.enable.dictionary#{c}": "false" for c in ("key", "start", "n_tokens")}
    ordered.mapInArrow(run, schema).write.options(
        **{"parquet.writer.version": "v2", "parquet.block.size": str(ROW_GROUP), "parquet.page.size": str(PAGE), "compression": "zstd"} | encodings
    ).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files as written; a selection of columns reads no others, a filter on ``key`` skips pages."""
    return spark.read.parquet(path)


def with_start(tokens: DataFrame) -> DataFrame:
    """``start`` counted over all shards instead of within one: a sum per shard, one row for each
    file, from the counts alone."""
    total = tokens.groupBy("shard").agg(F.sum("n_tokens").alias("of_shard"))
    before = F.sum("of_shard").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))
    base = total.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    # Written, so that its size is known and the ids stay where they are.
    return tokens.join(small_side(base), "shard").withColumn("start", F.col("start") + F.col("base")).drop("base")


def with_crc32(tokens: DataFrame, into: str = "ids_crc32") -> DataFrame:
    """In place of ``ids``, the crc32 of the ids as little-endian unsigned 32-bit integers."""
    others = [c for c in tokens.columns if c not in ("ids", into)]
    schema = T.StructType([tokens.schema[c] for c in others] + [T.StructField(into, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + [pa.array(crc, pa.int64())], names=[*others, into])

    return tokens.select(*others, "ids").mapInArrow(run, schema)
