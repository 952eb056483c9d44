"""Best-fit packing of documents into token sequences.

Documents are tokenized, pieces are cut only where a document is longer than a sequence, and
pieces are packed by bounded-space online best-fit: a fixed number of bins is open, a bitset
keyed by free space finds the tightest one that still takes a piece, and when too many are open
the fullest closes first.  Pieces are dealt to groups of a bounded number of tokens that are
packed apart; what stands in bins still open at a group's end goes to the next round, so only
the last round leaves bins that are not full.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genopile.llm.common import table
from genopile.storage import materialize

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Packing:
    size: int = 4096
    end_id: int = 1
    open_bins: int = 512
    # What one group holds: pieces are dealt to as many groups as this asks for.
    group_tokens: int = 1 << 26
    group_pieces: int = 1 << 19
    # A bin this full is closed at the end of a group.
    full_enough: float = 0.995


# A lower-cased word, then ASCII punctuation without an apostrophe: tokenized apart by any text.
WORD_AND_MARKS = re.compile(rb"^([a-z\x80-\xff]*)([!-&(-/:-@\[-`{-~]*)(.*)$", re.MULTILINE)


# Bytes of a chunk in a dictionary: its share of the table, its name and its number.
ENTRY = 200


class ChunkIds:
    """Token ids of texts, with the ids of every blank-separated chunk computed once.

    The tokenizer's patterns match no white space, so the ids of a text are the ids of its
    chunks in order.  It lower-cases, so chunks are looked up lower-cased, except in texts that
    may hold one of its special tokens.  Chunks that are one word and marks are tokenized many
    at a time: the ids of each word end at the one that closes a word.  Where the closing ids do
    not count up to the words, each is tokenized alone.

    Most chunks are met once.  When the store holds more than ``limit`` bytes, the chunks that were
    met most often stay, in half of the limit, and the others go.  It is looked at after every
    block of texts, so it exceeds the limit by the chunks of one block at most.
    """

    def __init__(self, path: str, limit: int = 64 << 20, joined: int = 256) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit, self.joined = limit, joined
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.places = _Places()
        self.runs, self.run_ids = _Places(), [[]]
        self.runs[b""] = 0
        self.starts, self.lengths, self.flat = array("q"), array("q"), array("I")
        self.met = np.zeros(0, np.int64)

    def size(self) -> int:
        """About the bytes held: ids, and a chunk's place, name and entry."""
        return 4 * len(self.flat) + (ENTRY + 16) * len(self.places)

    def _shrink(self) -> None:
        """Keep the chunks met most often, in half of the limit."""
        starts, lengths = np.array(self.starts), np.array(self.lengths)
        order = np.argsort(-self.met, kind="stable")
        few = np.cumsum(4 * lengths[order] + ENTRY + 16) <= self.limit // 2
        kept = np.sort(order[few & (self.met[order] > 1)])
        names, flat = list(self.places), np.frombuffer(self.flat, np.uint32)
        n = lengths[kept]
        ends = np.cumsum(n)
        at = np.repeat(starts[kept] - (ends - n), n) + np.arange(int(n.sum()))
        self.flat, flat = array("I", flat[at].tobytes()), None
        self.starts, self.lengths = array("q", (ends - n).tobytes()), array("q", n.tobytes())
        self.met = self.met[kept] // 2
        self.places = _Places()
        for place, i in enumerate(kept.tolist()):
            self.places[names[i]] = place

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        groups = [words[i : i + self.joined] for i in range(0, len(words), self.joined)]
        flat, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            ids = np.array(ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(group):
                flat.append(ids)
                sizes.append(np.diff(ends, prepend=0))
            else:
                apart = self._encode(group)
                flat.append(np.fromiter(chain.from_iterable(apart), np.uint32))
                sizes.append(np.fromiter(map(len, apart), np.int64, len(apart)))
        return np.concatenate(flat), np.concatenate(sizes)

    def _add(self, chunks: list[bytes]) -> None:
        """Append the ids of new chunks, in the order in which they got their places.

        A chunk is a word and a run of marks, or is tokenized whole; words, runs and whole chunks
        are parts in one table, from which every chunk's ids are gathered.
        """
        words, marks, rests = zip(*WORD_AND_MARKS.findall(b"\n".join(chunks)))
        stems = _Places()
        stem = np.fromiter(map(stems.__getitem__, words), np.int64, len(words))
        texts = b"\n".join(stems).decode("utf-8").split("\n")
        plain = np.fromiter((t.isalpha() for t in texts), bool, len(texts))
        alone = ~plain[stem] | np.fromiter(map(bool, rests), bool, len(rests))
        run = np.fromiter(map(self.runs.__getitem__, marks), np.int64, len(marks))
        if unseen := self.runs.since(len(self.run_ids)):
            self.run_ids += self._encode([x.decode("utf-8") for x in unseen])
        flat, sizes = self._of_words([t for t, p in zip(texts, plain) if p])
        whole = self._encode([chunks[i].decode("utf-8") for i in np.flatnonzero(alone)])
        more = [*self.run_ids, *whole]
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(more), np.uint32)])
        sizes = np.concatenate([sizes, np.fromiter(map(len, more), np.int64, len(more))])
        begins = np.cumsum(sizes) - sizes
        # Parts of every chunk by their places in the table; run 0 is empty.
        n_words, n_runs = int(plain.sum()), len(self.run_ids)
        first = np.where(alone, n_words + n_runs + np.cumsum(alone) - 1, (np.cumsum(plain) - 1)[stem])
        parts = np.stack([first, n_words + np.where(alone, 0, run)], 1).reshape(-1)
        n = sizes[parts]
        ends = np.cumsum(n)
        ids = flat[np.repeat(begins[parts] - (ends - n), n) + np.arange(int(n.sum()))]
        n = n.reshape(-1, 2).sum(1)
        starts = len(self.flat) + np.cumsum(n) - n
        self.flat.frombytes(ids.tobytes())
        self.starts.frombytes(starts.tobytes())
        self.lengths.frombytes(n.tobytes())

    def of(self, texts: list[bytes]) -> list[np.ndarray]:
        if self.size() > self.limit:
            self._shrink()
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(
            map(self.places.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum())
        )
        if new := self.places.since(len(self.lengths)):
            self._add(new)
        if not len(at):
            return [np.empty(0, np.uint32) for _ in texts]
        self.met = np.bincount(at, minlength=len(self.places)) + np.pad(
            self.met, (0, len(self.places) - len(self.met))
        )
        n = np.frombuffer(self.lengths, np.int64)[at]
        ends = np.cumsum(n)
        steps = np.arange(int(ends[-1]))
        ids = np.frombuffer(self.flat, np.uint32)[
            np.repeat(np.frombuffer(self.starts, np.int64)[at] - (ends - n), n) + steps
        ]
        cuts = np.r_[0, ends][np.cumsum(counts)]
        return np.split(ids, cuts[:-1])


class _Places(dict):
    """Numbers chunks as they are first looked up."""

    def __missing__(self, chunk: bytes) -> int:
        place = self[chunk] = len(self)
        return place

    def since(self, first: int) -> list[bytes]:
        return list(islice(self, first, None))


def _blocks(texts: list[bytes | None], most: int = 1 << 21) -> Iterator[list[bytes]]:
    block, size = [], 0
    for t in texts:
        block.append(t or b"")
        size += len(block[-1])
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


@lru_cache(maxsize=1)
def _chunk_ids(path: str) -> ChunkIds:
    """One tokenizer a worker process, for all its tasks."""
    return ChunkIds(path)


def _cut(path: str, options: Packing, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _chunk_ids(path)
        for batch in (large.slice(i, 256) for large in batches for i in range(0, large.num_rows, 256)):
            at = 0
            for block in _blocks(batch.column(1).to_pylist()):
                doc, piece, start, length, crc, kept = [], [], [], [], [], []
                for ids in ids_of.of(block):
                    ids = np.append(ids, options.end_id).astype("<u4")
                    for i, begin in enumerate(range(0, len(ids), options.size)):
                        part = ids[begin : begin + options.size]
                        doc.append(at)
                        piece.append(i)
                        start.append(begin)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            kept.append(part.astype(np.int64))
                    at += 1
                columns = {
                    "key": batch.column(0).take(pa.array(doc, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(kept, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)
        # Workers outlive their tasks; what is stored goes, as other steps need the memory.
        ids_of.clear()

    return run


def pieces(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    options: Packing = Packing(),
    with_ids: bool = False,
) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``) of every piece.

    A null or empty text is its end id alone.  Columns other than key and text are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long"
    chosen = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").cast("binary").alias("t")
    )
    return chosen.mapInArrow(
        _cut(path, options, with_ids), schema + (", ids array<long>" if with_ids else "")
    )


def best_fit(lengths: list[int], options: Packing) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of every piece in order, and the final free space of every bin.

    Bins still open at the end have a free space below zero: ``-1 - free``.
    """
    size = options.size
    levels: list[list[int]] = [[] for _ in range(size + 1)]
    free: list[int] = []
    mask = n_open = 0
    bins, offsets = [], []
    for length in lengths:
        fitting = mask >> length
        if fitting:
            level = length + (fitting & -fitting).bit_length() - 1
            chosen = levels[level].pop()
            if not levels[level]:
                mask ^= 1 << level
            n_open -= 1
        else:
            level, chosen = size, len(free)
            free.append(size)
        bins.append(chosen)
        offsets.append(size - level)
        left = free[chosen] = level - length
        if left:
            levels[left].append(chosen)
            mask |= 1 << left
            n_open += 1
            if n_open > options.open_bins:
                fullest = (mask & -mask).bit_length() - 1
                levels[fullest].pop()
                if not levels[fullest]:
                    mask ^= 1 << fullest
                n_open -= 1
    for level, still in enumerate(levels):
        for one in still:
            free[one] = -1 - level
    return bins, offsets, free


def _round(number: int, last: bool, options: Packing):
    def run(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "row"])
        bins, offsets, free = best_fit(rows["length"].tolist(), options)
        left = np.asarray(free)[bins]
        enough = (1 - options.full_enough) * options.size
        closed = (left >= 0) | (-1 - left <= enough) | last
        base = ((number << 26) + int(group[0])) << 32
        return pd.DataFrame(
            {
                "row": rows["row"].to_numpy(),
                "length": rows["length"].to_numpy(),
                "sequence_id": base + np.asarray(bins, dtype=np.int64),
                "offset": np.asarray(offsets, dtype=np.int64),
                "closed": closed,
            }
        )

    return run


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    options: Packing = Packing(),
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset``.

    Repeated rows and repeated keys are packed each on its own; a null key stays null; an empty
    table gives an empty result.  Pieces are stored once in the shared folder with a row number
    that deals them to groups, so neither equal keys nor equal texts meet in one group, and a
    lost executor's work is repeated with the same result.
    """
    cut = pieces(docs, path, key, text, options, with_ids)
    cut = materialize(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    left = cut.select("row", "length")
    placed, number, before = None, 0, 0
    schema = "row long, length long, sequence_id long, offset long, closed boolean"
    while True:
        sums = left.agg(F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("n")).first()
        groups = max(
            1, -(-(sums["tokens"] or 0) // options.group_tokens), -(-sums["n"] // options.group_pieces)
        )
        last = groups == 1 or groups == before
        order = F.xxhash64("row", F.lit(number))
        dealt = left.select("row", "length", order.alias("order")).withColumn(
            "group", F.pmod("order", F.lit(groups))
        )
        done = materialize(
            dealt.groupBy("group").applyInPandas(_round(number, last, options), schema), "packed"
        )
        closed = done.filter("closed").select("row", "sequence_id", "offset")
        placed = closed if placed is None else placed.unionByName(closed)
        if last:
            break
        left, number, before = done.filter("not closed").select("row", "length"), number + 1, groups
    return cut.join(placed, "row").select(
        F.col("key").alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
        *(["ids"] if with_ids else []),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
