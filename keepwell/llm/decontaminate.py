"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of ten consecutive words (a shorter item is one
window). A document contains a window if it contains every shingle of it, so the
join may look at one necessary token alone: the window's rarest shingle, by
counts over all documents. Each hit of that token proposes one start in the
document; length and positional bounds (the window must lie inside the
document's words) drop impossible starts, a window hash drops most others, and
the words of what is left are compared one by one.

The items are the given query set. They are taken in blocks of at most about
``BLOCK_BYTES`` of text, whatever their number; each block's index travels to
the tasks, and documents stay where they are read (no shuffle of documents).

Null and empty documents have no words and no hits. Items without
text or without words are ignored; the windows of items without an id count as hits, though no id is listed for them; rows that repeat an item add nothing; several
rows of one id count as one item. Equal counts are ordered by hash. An empty item
table contaminates nothing. Other columns pass through ``scan`` untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from keepwell.llm.arrays import ALPHANUMERIC, Block, Words, blocks, ragged, unused, window_hash
from keepwell.session import ship_package

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 8 << 20
_BITS = 22


class Filter:
    """Sorted keys with a bit table in front; ``find`` gives (positions in the input, key numbers)."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.flag = np.zeros(1 << _BITS, bool)
        self.flag[self.keys >> np.uint64(64 - _BITS)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.flag[values >> np.uint64(64 - _BITS)])
        if not len(at) or not len(self.keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        number = np.searchsorted(self.keys, values[at])
        number[number == len(self.keys)] = 0
        same = self.keys[number] == values[at]
        return at[same], number[same]


class Windows:
    """The windows of a block of items: their shingles, words and owners."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW, shingle: int = SHINGLE):
        self.ids = [i for i, _ in items]
        block = Block([(t or "").encode() for _, t in items])
        words = Words(block, ALPHANUMERIC, lower=True)
        wide = words.count >= window
        first = ragged(words.first, np.where(wide, words.count - window + 1, np.minimum(words.count, 1)))
        self.item = words.owner[first] if len(first) else first
        self.width = np.where(wide[self.item], window, words.count[self.item])
        self.token_width = np.minimum(self.width, shingle)
        self.hash = np.zeros(len(first), np.uint64)
        for width in np.unique(self.width):
            rows = self.width == width
            self.hash[rows] = window_hash(words.hash, first[rows], int(width))
        low = [bytes(block.data[s:e]).lower() for s, e in zip(words.start, words.end)]
        self.words = [b" ".join(low[f : f + w]) for f, w in zip(first.tolist(), self.width.tolist())]
        # tokens: all shingles of all windows
        n = self.width - self.token_width + 1
        self.of = np.repeat(np.arange(len(first)), n)
        self.offset = ragged(np.zeros(len(n), np.int64), n)
        self.token = np.zeros(len(self.of), np.uint64)
        for width in np.unique(self.token_width):
            rows = self.token_width[self.of] == width
            self.token[rows] = window_hash(words.hash, first[self.of[rows]] + self.offset[rows], int(width))

    def widths(self) -> list[int]:
        return [int(w) for w in np.unique(self.token_width)]

    def tokens(self, width: int) -> np.ndarray:
        return self.token[self.token_width[self.of] == width]


class Index:
    """Windows filed under their rarest token; ``counts`` are the tokens' numbers in the corpus."""

    def __init__(self, windows: Windows, counts: dict[int, int]):
        self.w = windows
        seen = np.array([counts.get(t, 0) for t in windows.token.view(np.int64).tolist()], np.int64)
        order = np.lexsort((windows.offset, windows.token, seen, windows.of))
        rarest = order[np.r_[True, windows.of[order][1:] != windows.of[order][:-1]]] if len(order) else order
        self.parts = []
        for width in windows.widths():
            mine = rarest[windows.token_width[windows.of[rarest]] == width]
            mine = mine[np.argsort(windows.token[mine], kind="stable")]
            table = Filter(windows.token[mine])
            begin = np.searchsorted(windows.token[mine], table.keys, "left")
            end = np.searchsorted(windows.token[mine], table.keys, "right")
            self.parts.append((width, table, begin, end - begin, windows.of[mine], windows.offset[mine]))

    def matches(self, block: Block, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word in the block, window) of every occurrence."""
        found = []
        last = words.first + words.count
        for width, table, begin, size, window, offset in self.parts:
            at, token = words.windows(width)
            hit, key = table.find(token)
            n = size[key]
            row = ragged(begin[key], n)
            place, which = np.repeat(at[hit], n), window[row]
            start, need = place - offset[row], self.w.width[which]
            owner = words.owner[place] if len(place) else place
            inside = (
                (need <= words.count[owner]) & (start >= words.first[owner]) & (start + need <= last[owner])
            )
            start, which = start[inside], which[inside]
            for need in np.unique(self.w.width[which]):
                rows = self.w.width[which] == need
                same = window_hash(words.hash, start[rows], int(need)) == self.w.hash[which[rows]]
                for s, k in zip(start[rows][same].tolist(), which[rows][same].tolist()):
                    text = [block.data[words.start[i] : words.end[i]].tobytes() for i in range(s, s + int(need))]
                    if b" ".join(text).lower() == self.w.words[k]:
                        found.append((s, k))
        pairs = np.array(sorted(set(found)), np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


def token_counts(docs: DataFrame, windows: Windows, text: str = "text") -> dict[int, int]:
    """How often each token of the items occurs in all documents; at most one row per token returns."""
    ship_package(docs.sparkSession)
    tables = docs.sparkSession.sparkContext.broadcast([(w, Filter(windows.tokens(w))) for w in windows.widths()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(len(t.keys), np.int64) for _, t in tables.value]
        for batch in batches:
            for _, block in blocks(batch, "text"):
                words = Words(block, ALPHANUMERIC, lower=True)
                for (width, table), total in zip(tables.value, totals):
                    _, key = table.find(words.windows(width)[1])
                    total += np.bincount(key, minlength=len(total))
        for (_, table), total in zip(tables.value, totals):
            some = total > 0
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(table.keys[some].view(np.int64)), pa.array(total[some])], ["token", "n"]
                )

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "token long, n long")
    return {r.token: r.n for r in rows.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def item_blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The items with a text, as lists of about ``block_bytes`` of text; an id may be null."""
    rows = items.select(F.col(key).cast("string").alias("id"), F.col(text).alias("t")).dropna(subset=["t"]).distinct()
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "t"), F.lit(n)) == i)
        found = [(r.id, r.t) for r in part.collect()]
        if found:
            yield found


def scan(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
    names: tuple[str, str, str] = ("n_words", "hit_words", "hit_items"),
) -> DataFrame:
    """``docs`` with three more columns: number of words, numbers of the words inside any
    window, ids of the items with a window (both lists may repeat between blocks of items)."""
    spark = docs.sparkSession
    ship_package(spark)
    place, width = docs.columns.index(text), len(docs.columns)
    schema = StructType(
        [
            *docs.schema.fields,
            StructField(names[0], IntegerType()),
            StructField(names[1], ArrayType(IntegerType())),
            StructField(names[2], ArrayType(StringType())),
        ]
    )

    def step(index, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, block in blocks(batch, batch.schema.names[place]):
                    words = Words(block, ALPHANUMERIC, lower=True)
                    marks = [[] for _ in block.texts]
                    hits = [[] for _ in block.texts]
                    if index is not None:
                        start, which = index.value.matches(block, words)
                        w = index.value.w
                        size = w.width[which]
                        inside = np.unique(ragged(start, size))
                        for owner, word in zip(words.owner[inside].tolist(), inside.tolist()):
                            marks[owner].append(word - int(words.first[owner]))
                        owner = words.owner[start] if len(start) else start
                        # an item without an id has windows, too, but nothing to be listed by
                        named = {(o, w.ids[i]) for o, i in zip(owner.tolist(), w.item[which].tolist()) if w.ids[i] is not None}
                        for o, i in sorted(named):
                            hits[o].append(i)
                    if not first:
                        marks = [a + b for a, b in zip(part.column(width + 1).to_pylist(), marks)]
                        hits = [a + b for a, b in zip(part.column(width + 2).to_pylist(), hits)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            *part.columns[:width],
                            pa.array(words.count.astype(np.int32)),
                            pa.array(marks, pa.list_(pa.int32())),
                            pa.array(hits, pa.list_(pa.string())),
                        ],
                        [*schema.names],
                    )

        return run

    out, first = docs, True
    for found in item_blocks(items, item_key, item_text, block_bytes):
        windows = Windows(found, window, shingle)
        index = Index(windows, token_counts(docs, windows, text))
        out, first = out.mapInArrow(step(spark.sparkContext.broadcast(index), first), schema), False
    return out.mapInArrow(step(None, True), schema) if first else out


def report(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: numbers of words, of hit words, of items; digest of the items' ids; the verdict."""
    found = scan(docs.select(F.col(key), F.col(text).alias("text")), items, **options)
    ids = F.array_sort(F.array_distinct("hit_items"))
    return found.select(
        key,
        F.col("n_words").cast("long").alias("n_words"),
        F.size(F.array_distinct("hit_words")).cast("long").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any window of an item."""
    names = tuple(unused(docs.columns, f"__scan_{i}") for i in range(3))
    found = scan(docs, items, text, names=names, **options)
    return found.where(F.size(names[1]) == 0).drop(*names)
