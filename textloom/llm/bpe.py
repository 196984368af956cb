"""Byte-level BPE: speculate with the longest match, verify pairs, merge exactly only where that fails.

A text is cut into words by the pre-tokenizer. For each word not seen before, the longest
matching tokens are proposed from the left. A proposal is the BPE result exactly if each token
encodes to itself and each adjacent pair of tokens would not have merged across its border; the
second is tested for all pairs of a batch at once by undoing merges from the latest backwards.
Words with a failing pair are merged exactly.

Defined results: a null text encodes like an empty one, to no tokens; strings of added tokens in
a text become those tokens; a text of any length is encoded whole; equal rows give equal results;
an empty table gives no rows; columns other than the two named are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm import worker

# Fixed value: the word pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What a worker remembers of words and their tokens before it starts anew.
CACHE_WORDS, CACHE_TOKENS = 500_000, 2_500_000
_FAR = np.int64(1) << 40


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def tables_of(file: str) -> dict:
    """Plain tables of a tokenizer file's content."""
    spec = json.loads(file)
    model, pre = spec["model"], spec["pre_tokenizer"]
    plain = not (spec["normalizer"] or model["end_of_word_suffix"] or model["continuing_subword_prefix"] or model["dropout"])
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not plain:
        raise ValueError("not a plain byte-level BPE tokenizer")
    to_byte = byte_characters()
    return {
        "vocabulary": {bytes(to_byte[c] for c in word): i for word, i in model["vocab"].items()},
        "merges": [tuple(bytes(to_byte[c] for c in side) for side in (m if isinstance(m, list) else m.split(" "))) for m in model["merges"]],
        "added": {t["content"]: t["id"] for t in spec["added_tokens"]},
    }


def _token_texts(tables: dict) -> dict[int, bytes]:
    return {i: w for w, i in tables["vocabulary"].items()} | {i: w.encode() for w, i in tables["added"].items()}


def _decode(text_of: dict[int, bytes], ids: list[int]) -> str:
    return b"".join([text_of.get(i, b"") for i in ids]).decode("utf-8", "replace")


class Pieces:
    """Remembered token lists, by code: flat ids with a start and a count for each code."""

    def __init__(self):
        self.flat, self.start, self.count = worker.Growing(np.int32), worker.Growing(np.int64), worker.Growing(np.int64)

    def put(self, flat: np.ndarray, count: np.ndarray) -> range:
        """Codes of new lists, given flat with a count for each."""
        first = len(self.start)
        self.start.append(len(self.flat) + np.cumsum(count) - count)
        self.count.append(count)
        self.flat.append(flat)
        return range(first, first + len(count))

    def join(self, code: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and counts of rows, each given by so many codes."""
        width = self.count[code]
        ends = np.cumsum(width)
        at = np.repeat(self.start[code] - (ends - width), width) + np.arange(int(width.sum()))
        sums, last = np.concatenate([[0], ends]), np.cumsum(sizes)
        return self.flat[at], sums[last] - sums[last - sizes]


class Codec:
    """Encodes and decodes; tokens are numbered by the order in which merges make them."""

    def __init__(self, tables: dict):
        vocabulary, merges = tables["vocabulary"], tables["merges"]
        made = [a + b for a, b in merges]
        if len({*made}) < len(made):
            raise ValueError("two merges make the same token")
        names = [bytes([b]) for b in range(256)] + made
        number = {word: i for i, word in enumerate(names)}
        self.width = len(names)
        self.left = np.arange(self.width, dtype=np.int64)
        self.right = self.left.copy()
        for i, (a, b) in enumerate(merges, 256):
            self.left[i], self.right[i] = number[a], number[b]
        self.rank = {(number[a], number[b]): i for i, (a, b) in enumerate(merges, 256)}
        keys = self.left[256:] * self.width + self.right[256:]
        order = np.argsort(keys)
        self.pair_keys, self.pair_values = keys[order], order + 256
        self.id_of = np.array([vocabulary[word] for word in names], dtype=np.int32)
        self._forget()
        # Only tokens that their own bytes merge to can be proposed.
        merged, count = self.merge_all(names)
        whole = (count == 1) & (merged[np.cumsum(count) - count] == np.arange(self.width))
        self._build_trie([(w, i) for i, w in enumerate(names) if whole[i]])
        self.added = tables["added"]
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.text_of = _token_texts(tables)
        self.pattern = regex.compile(PATTERN)

    def _forget(self) -> None:
        self.pieces = Pieces()
        self.words: dict[str | int, int] = {}
        self.first: dict[bytes, int] = {}
        self.later: dict[bytes, int] = {}

    # -- words ------------------------------------------------------------------------------

    def _build_trie(self, words: list[tuple[bytes, int]]) -> None:
        node_of = {b"": 0}
        edges, token = [], [-1]
        for word, i in sorted(words):
            for size in range(1, len(word) + 1):
                if word[:size] not in node_of:
                    edges.append((node_of[word[: size - 1]] * 256 + word[size - 1], len(node_of)))
                    node_of[word[:size]] = len(node_of)
                    token.append(-1)
            token[node_of[word]] = i
        edges.sort()
        self.edge_keys, self.edge_nodes = (np.array(x, dtype=np.int64) for x in zip(*edges))
        self.token_at = np.array(token, dtype=np.int64)

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Longest matching tokens from the left, for all words at once: flat tokens, count per word."""
        data = np.frombuffer(b"".join(words) + b"\0", dtype=np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size)
        row = np.flatnonzero(size)
        at, end = (end - size)[row], end[row]
        node, best, best_end = np.zeros_like(at), np.full_like(at, -1), at.copy()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(row):
            key = node * 256 + data[at]
            edge = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            on = (self.edge_keys[edge] == key) & (at < end)
            node = np.where(on, self.edge_nodes[edge], 0)
            at = at + on
            token = self.token_at[node]
            better = on & (token >= 0)
            best, best_end = np.where(better, token, best), np.where(better, at, best_end)
            off = ~on
            found.append((row[off], best[off]))
            at = np.where(on, at, best_end)
            stay = on | (best_end < end)
            if not stay.all():
                row, at, end, node, best, best_end = (x[stay] for x in (row, at, end, node, best, best_end))
        rows = np.concatenate([x[0] for x in found] or [np.zeros(0, np.int64)])
        tokens = np.concatenate([x[1] for x in found] or [np.zeros(0, np.int64)])
        return tokens[np.argsort(rows, kind="stable")], np.bincount(rows, minlength=len(words))

    def _made(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that merges each pair, or a far larger number."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_values[at], _FAR)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of adjacent tokens: no merge crosses their border before both are whole."""
        good = np.ones(len(a), dtype=bool)
        open_, limit = np.arange(len(a)), np.full(len(a), _FAR)
        while len(open_):
            crosses = self._made(a, b) < limit
            good[open_[crosses]] = False
            # The later of the two merges is undone; two single bytes end the search.
            ended = (self.left[b] == b) & (self.right[a] == a)
            undo_a = a > b
            limit = np.where(undo_a, a, b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
            stay = ~crosses & ~ended
            open_, limit, a, b = open_[stay], limit[stay], a[stay], b[stay]
        return good

    def _merge_matrix(self, words: list[bytes]) -> list[np.ndarray]:
        """Exact merging of words of at most 64 bytes, a row each: the earliest merge, leftmost
        among equals, is applied to all rows at once until none applies."""
        size = max(map(len, words))
        token = np.frombuffer(b"".join(w.ljust(size + 1, b"\0") for w in words), np.uint8).reshape(-1, size + 1).astype(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        column = np.arange(size)
        token[np.arange(size + 1) >= length[:, None]] = -1
        made = self._made(token[:, :-1], token[:, 1:])
        made[(token[:, 1:] < 0)] = _FAR
        row, done = np.arange(len(words)), [None] * len(words)
        while len(row):
            at = made.argmin(axis=1)
            every = np.arange(len(row))
            best = made[every, at]
            open_ = best < _FAR
            for i, tokens in zip(row[~open_].tolist(), token[~open_]):
                done[i] = tokens[tokens >= 0]
            row, token, made, at, best, every = row[open_], token[open_], made[open_], at[open_], best[open_], every[: open_.sum()]
            if not len(row):
                break
            token[every, at] = best
            shift = column + (column > at[:, None])
            token[:, :-1] = np.take_along_axis(token, shift, axis=1)
            token[:, -1] = -1
            made = np.take_along_axis(np.concatenate([made, np.full((len(row), 1), _FAR)], axis=1), shift, axis=1)
            for k in (at - 1, at):
                side = k >= 0
                a, b = token[every[side], k[side]], token[every[side], k[side] + 1]
                made[every[side], k[side]] = np.where(b < 0, _FAR, self._made(a, np.maximum(b, 0)))
        return done

    def _merge_long(self, word: bytes) -> list[int]:
        token, last = [*word], len(word)
        before, after = [*range(-1, last - 1)], [*range(1, last + 1)]
        heap = [(self.rank[pair], i, *pair) for i, pair in enumerate(zip(token, token[1:])) if pair in self.rank]
        heapq.heapify(heap)
        while heap:
            made, at, a, b = heapq.heappop(heap)
            right = after[at]
            if token[at] != a or right >= last or token[right] != b:
                continue
            token[at], token[right] = made, -1
            after[at] = after[right]
            if after[at] < last:
                before[after[at]] = at
            for one in (before[at], at):
                if one >= 0 and after[one] < last:
                    pair = (token[one], token[after[one]])
                    if pair in self.rank:
                        heapq.heappush(heap, (self.rank[pair], one, *pair))
        return [t for t in token if t >= 0]

    def merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging: flat tokens and a count per word. Words of similar length go together."""
        done: list = [None] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_size.setdefault(next((m for m in (6, 9, 12, 16, 24, 64) if len(word) <= m), 0), []).append(i)
        for most, own in by_size.items():
            for k in range(0, len(own), 20_000):
                part = own[k : k + 20_000]
                some = [words[i] for i in part]
                for i, tokens in zip(part, self._merge_matrix(some) if most else map(self._merge_long, some)):
                    done[i] = tokens
        return np.concatenate([np.zeros(0, np.int64), *done]).astype(np.int64), np.fromiter(map(len, done), np.int64, len(done))

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each word: proposals, one test of all their pairs, exact merging of the rest."""
        flat, count = self.propose(words)
        last = np.cumsum(count) - 1
        inner = np.ones(len(flat), dtype=bool)
        inner[last[count > 0]] = False
        at = np.flatnonzero(inner)
        if not len(at):
            return flat, count
        keys, back = np.unique(flat[at] * self.width + flat[at + 1], return_inverse=True)
        good = self.compatible(keys // self.width, keys % self.width)[back]
        failing = np.unique(np.searchsorted(last, at[~good]))
        merged, merged_count = self.merge_all([words[i] for i in failing.tolist()])
        # Proposals of the words that passed and merged tokens of the others, in the words' order.
        failed = np.zeros(len(words), dtype=bool)
        failed[failing] = True
        both = np.concatenate([flat[~np.repeat(failed, count)], merged])
        word = np.arange(len(words))
        owner = np.concatenate([np.repeat(word[~failed], count[~failed]), np.repeat(failing, merged_count)])
        count[failing] = merged_count
        return both[np.argsort(owner, kind="stable")], count

    def _learn(self, words: set[str]) -> None:
        new = [*words.difference(self.words)]
        if new:
            flat, count = self.encode_words([w.encode() for w in new])
            self.words.update(zip(new, self.pieces.put(self.id_of[flat], count)))

    def _add(self, store: dict[bytes, int], new: list[bytes], space: str) -> None:
        """Remember pieces of text; a piece that follows a space is stored without it.

        A piece with white space at an end cannot stand alone, as that could belong to a longer run:
        it gets no code. All others are cut into words in one go, as lines.
        """
        strings = [piece.decode() for piece in new]
        lone = [s.split() == [s] for s in strings]
        words = self.pattern.findall("\n".join([space + s for s, ok in zip(strings, lone) if ok]))
        ends = [i for i, w in enumerate(words) if w == "\n"]
        plain = [piece for piece, ok in zip(new, lone) if ok]
        bounds = [-1, *ends, len(words)] if plain else [-1]
        sizes = [b - a - 1 for a, b in zip(bounds, bounds[1:])]
        words = [w for w in words if w != "\n"]
        for piece, string, ok in zip(new, strings, lone):
            if not ok and (not string or string[-1].isspace() or string[0].isspace()):
                store[piece] = -1
            elif not ok:
                own = self.pattern.findall(space + string)
                words += own
                sizes.append(len(own))
                plain.append(piece)
        self._learn({*words})
        code = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        flat, count = self.pieces.join(code, np.array(sizes, dtype=np.int64))
        store.update(zip(plain, self.pieces.put(flat, count)))

    # -- texts ------------------------------------------------------------------------------

    def _codes(self, rows: list[bytes]) -> list[array]:
        """Codes of the remembered pieces that make up each text.

        A single space between two characters that are no white space always starts a word, so
        texts are cut there. Texts with other spaces or with added tokens are cut by the pattern.
        """
        special = [w.encode() for w in self.added]
        cut = [None if any(w in text for w in special) else text.split(b" ") for text in rows]
        self._add(self.first, [*{x[0] for x in cut if x}.difference(self.first)], "")
        wanted: set[bytes] = set()
        for pieces in cut:
            wanted.update(pieces[1:] if pieces else ())
        self._add(self.later, [*wanted.difference(self.later)], " ")
        found = []
        for pieces, text in zip(cut, rows):
            codes = array("q")
            if pieces:
                codes.append(self.first[pieces[0]])
                codes.extend(map(self.later.__getitem__, pieces[1:]))
            if (not pieces or -1 in codes) and text:
                codes = self._codes_by_pattern(text.decode())
            found.append(codes if text else array("q"))
        return found

    def _codes_by_pattern(self, text: str) -> array:
        cut: list[str | int] = []
        at = 0
        for match in self.added_pattern.finditer(text) if self.added_pattern else ():
            cut += self.pattern.findall(text[at : match.start()])
            cut.append(self.added[match[0]])
            at = match.end()
        cut += self.pattern.findall(text[at:])
        self._learn({w for w in cut if isinstance(w, str)})
        for token in {w for w in cut if isinstance(w, int)}.difference(self.words):
            self.words[token] = self.pieces.put(np.array([token]), np.array([1]))[0]
        return array("q", map(self.words.__getitem__, cut))

    def encode(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat token ids of all texts and the number of tokens in each."""
        if len(self.pieces.start) > CACHE_WORDS or len(self.pieces.flat) > CACHE_TOKENS:
            self._forget()
        codes = self._codes(rows)
        sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        flat = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, dtype=np.int64) for x in codes)])
        return self.pieces.join(flat, sizes)

    def decode(self, ids: list[int]) -> str:
        """Text of the tokens; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        return _decode(self.text_of, ids)


def _sent(spark: SparkSession, path: str, build: Callable[[dict], object]) -> Callable:
    """A function that gives what ``build`` makes of the tokenizer inside tasks. The file is read
    here and sent along: it is as small as a vocabulary, and executors may not see the path."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    tables_of(content)  # an unfit file fails here
    sent = spark.sparkContext.broadcast(content)
    key = (build.__name__, hashlib.sha256(content.encode()).hexdigest())
    return lambda: worker.kept(key, lambda: build(tables_of(sent.value)))


def encode(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", decoded: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array of int): the tokens of each whole text; with ``decoded``, one more
    column of that name with the text that these tokens decode to, made in the same pass."""
    codec_here = _sent(df.sparkSession, tokenizer, Codec)
    kind = df.schema[key].dataType
    fields = [T.StructField("key", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("decoded", T.StringType())] if decoded else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_here()
        for batch in worker.slices(batches, "text"):
            ids, counts = codec.encode(worker.texts(batch, "text"))
            columns = [batch.column("key"), worker.lists(ids, counts, pa.int32())]
            if decoded:
                ends = np.cumsum(counts)
                columns.append(pa.array([codec.decode(ids[a:b].tolist()) for a, b in zip(ends - counts, ends)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = rows.mapInArrow(run, T.StructType(fields)).withColumnRenamed("key", key)
    return found.withColumnRenamed("decoded", decoded) if decoded else found


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """The frame with one more column: the text of ``ids``; null ids decode to an empty text."""
    texts_here = _sent(df.sparkSession, tokenizer, _token_texts)
    others = [c for c in df.columns if c != into]
    schema = T.StructType([df.schema[c] for c in others] + [T.StructField(into, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = texts_here()
        for batch in batches:
            decoded = [_decode(text_of, x) if x else "" for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], names=[*others, into])

    return df.select(others).mapInArrow(run, schema)
