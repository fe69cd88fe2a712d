"""Token counts of the sections of a document, by offsets.

A document is encoded once, whole. The bytes of its tokens follow one another, so
their lengths give every token's span of bytes and, through the places where
characters begin, of characters. Tokens are then joined to sections (half-open character
spans that do not overlap) by interval. A token that touches several sections is
counted once, by an explicit rule:

* ``first``  in the section that holds its first character
* ``last``   in the section that holds its last character
* ``most``   in the section that holds most of its characters, the earlier one among equals

A token whose deciding character lies in no section is counted in none. If the sections
tile the text, their counts add up to the document's. The default sections do: the lines
of the text, each with its line feed.

Nulls and empty texts have no lines and no rows. Sections that are null, end before
they start or reach beyond the text count what they meet. Repeated rows give repeated
rows, an empty table an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keepwell.llm.arrays import blocks
from keepwell.session import ship_package

RULES = ("first", "last", "most")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str | None = None):
    """(encoder, number of bytes of each token)."""
    import tiktoken

    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size


def spans(text: bytes, ids: list[int], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first character, character after the last) of every token; a token that holds only a
    part of a character has the span of that character."""
    end = np.cumsum(size[np.array(ids, np.int64)]) if len(ids) else np.empty(0, np.int64)
    start = end - size[np.array(ids, np.int64)] if len(ids) else end
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    before = np.r_[0, np.cumsum(begins)]  # characters that begin before each byte
    return before[start + 1] - 1, before[end]


def allocate(first: np.ndarray, after: np.ndarray, begin: np.ndarray, end: np.ndarray, rule: str) -> tuple:
    """(tokens counted in each section, of these how many also touch something else)."""
    order = np.argsort(begin, kind="stable")
    order = order[begin[order] < end[order]]
    low, high = begin[order], end[order]

    def holder(place: np.ndarray) -> np.ndarray:
        at = np.searchsorted(low, place, "right") - 1
        return np.where((at >= 0) & (place < high[np.maximum(at, 0)]), at, -1) if len(low) else np.full(len(place), -1)

    head, tail = holder(first), holder(after - 1)
    at = {"first": head, "last": tail}.get(rule)
    if at is None:
        at = head.copy()
        left = np.searchsorted(high, first, "right") if len(low) else head
        right = np.searchsorted(low, after, "left") if len(low) else head
        for t in np.flatnonzero(right - left > 1) if len(low) else ():
            share = np.minimum(high[left[t] : right[t]], after[t]) - np.maximum(low[left[t] : right[t]], first[t])
            at[t] = left[t] + int(share.argmax())
        one = right - left == 1 if len(low) else np.zeros(len(at), bool)
        at[one] = left[one]
    counted = at >= 0
    whole = counted & (first >= low[at] if len(low) else counted) & (after <= high[at] if len(low) else counted)
    count, across = (np.zeros(len(begin), np.int64) for _ in range(2))
    count[order] = np.bincount(at[counted], minlength=len(order))
    across[order] = np.bincount(at[counted & ~whole], minlength=len(order))
    return count, across


def attribute(
    docs: DataFrame,
    sections: Column | None = None,
    key: str = "doc_id",
    text: str = "text",
    rule: str = "first",
    path: str | None = None,
) -> DataFrame:
    """One row for each section: key, number and span of the section, tokens counted in it, of
    these how many reach beyond it, and the document's number of tokens. ``sections`` is an array of (start, end)
    structs in characters that do not overlap; lines if not given."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship_package(docs.sparkSession)
    path = path or default_path()
    own = sections is None
    names = [key, "section", "start", "end", "n_tokens", "n_across", "n_doc_tokens"]

    def bounds(part: pa.RecordBatch, block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not own:
            for spans_ in part.column(2).to_pylist():
                pairs = [(s["start"], s["end"]) for s in spans_ or () if s and None not in (s["start"], s["end"])]
                yield tuple(np.array(pairs, np.int64).reshape(-1, 2).T)
            return
        for value in block.texts:
            data = np.frombuffer(value, np.uint8)
            begins = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
            end = np.r_[begins[np.flatnonzero(data == 10) + 1], begins[-1]] if len(data) else begins[:0]
            yield np.r_[0, end[:-1]] if len(end) else end, end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, size = encoding(path)
        for batch in batches:
            for part, block in blocks(batch, "__text"):
                found = []
                for value, (begin, end) in zip(block.texts, bounds(part, block)):
                    ids = encoder.encode_ordinary(value.decode())
                    count, across = allocate(*spans(value, ids, size), begin, end, rule)
                    found.append((begin, end, count, across, np.full(len(begin), len(ids))))
                n = np.array([len(x[0]) for x in found])
                begin, end, count, across, total = (np.concatenate(x).astype(np.int64) for x in zip(*found))
                number = np.arange(len(begin)) - np.repeat(np.cumsum(n) - n, n)
                keys = part.column(0).take(pa.array(np.repeat(np.arange(len(n)), n)))
                yield pa.RecordBatch.from_arrays(
                    [keys, *(pa.array(x, pa.int64()) for x in (number, begin, end, count, across, total))], names
                )

    columns = [F.col(key), F.col(text).alias("__text")]
    if not own:
        columns.append(sections.alias("__sections"))
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(*columns).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"`{n}` long" for n in names[1:]))
