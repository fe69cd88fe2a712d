"""Quality rules with compression bands.

A text is kept if it passes the base rules (enough words, not made of repeated
word windows) and if its zstandard ratio, raw size over compressed size, lies
inside a band: over the whole text, and over each of its fixed-size chunks, the last
and shorter one included. A high ratio means repetition, a ratio near one means noise. Short
texts compress badly and long ones well, so the limits depend on the length: a chunk, too, is held
to the band of its own length.

Nulls and empty texts have no words and fail the base rules. Repeated rows are
judged alike, ties do not occur, an empty table gives an empty result, and
columns of the input other than the key and the text are ignored by ``assess``
and returned untouched by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from keepwell.llm.arrays import Block, Words, blocks, byte_codes, covered, mix, spans_hash
from keepwell.session import ship_package

LEVEL = 3
CHUNK = 4096
#: (texts of at least so many bytes, lowest ratio, highest ratio)
BANDS = (
    (0, 0.0, 1e9),  # too short to say anything
    (128, 0.9, 3.0),
    (512, 1.15, 3.5),
    (2048, 1.35, 4.5),
    (16384, 1.5, 5.5),
    (131072, 1.5, 7.0),
)
SYMBOLS = b"#*$%&|<>"
COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, kept boolean"
)


def _first_seen(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(how often each item's value occurs in its text, whether it is the first one)."""
    if not len(value):
        return np.empty(0, np.int64), np.empty(0, bool)
    key = mix(value ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(value), bool)
    is_first[first] = True
    return count[inverse], is_first


def base_counts(block: Block) -> dict[str, np.ndarray]:
    """The base rules' counts of each text of a block."""
    words = Words(block)
    starts_character = (block.data & 0xC0) != 0x80
    letters = np.flatnonzero(words.inside & starts_character)
    symbols = np.isin(block.data, np.frombuffer(SYMBOLS, np.uint8))

    # lines: between line feeds, and the bounds of each text
    feeds = np.flatnonzero(block.data == 10)
    end = np.sort(np.concatenate((feeds, block.finish)))
    owner = block.owner(end)
    start = np.concatenate(([0], end[:-1] + 1)) if len(end) else end
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, owner = start[has_word], end[has_word], owner[has_word]
    line = spans_hash(byte_codes(False)[block.data], start, end)
    _, is_first = _first_seen(owner, line)

    at, window = words.windows(5)
    count, _ = _first_seen(words.owner[at], window)
    repeated = covered(at[count > 1], 5, len(words))
    return {
        "n_words": words.count,
        "word_chars": block.per_text(block.owner(letters)),
        "n_symbols": block.per_text(block.owner(np.flatnonzero(symbols))),
        "n_dup_lines": block.per_text(owner[~is_first]),
        "n_repeat_words": block.per_text(words.owner[repeated]),
    }


def band(size: int, bands=BANDS) -> tuple[float, float]:
    return next((low, high) for least, low, high in reversed(bands) if size >= least)


def compression(text: bytes, compressor: zstandard.ZstdCompressor, bands=BANDS) -> tuple[float, int, int, bool]:
    """(ratio of the whole text, chunks, chunks outside their band, all within bands)."""
    if not text:
        return 0.0, 0, 0, True

    def judged(part: bytes) -> tuple[float, bool]:
        ratio = len(part) / len(compressor.compress(part))
        low, high = band(len(part), bands)
        return ratio, low <= ratio <= high

    ratio, fine = judged(text)
    places = range(0, len(text), CHUNK)
    bad = sum(not judged(text[i : i + CHUNK])[1] for i in places) if len(places) > 1 else int(not fine)
    return ratio, len(places), bad, fine and not bad


def assess(docs: DataFrame, key: str = "doc_id", text: str = "text", bands=BANDS) -> DataFrame:
    """``key`` and the counts, ratio and verdict of every text. One pass, no shuffle."""
    ship_package(docs.sparkSession)
    names = [part.split()[0] for part in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for part, block in blocks(batch, "text"):
                out = base_counts(block)
                out["base_failed"] = (out["n_words"] < 10) | (100 * out["n_repeat_words"] > 20 * out["n_words"])
                found = [compression(x, compressor, bands) for x in block.texts]
                ratio, n, bad, fine = (np.array(x) for x in zip(*found))
                out |= {"ratio": ratio, "n_chunks": n, "n_bad_chunks": bad, "kept": ~out["base_failed"] & fine}
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(out[c]) for c in names)], [key, *names]
                )

    narrow = docs.select(F.col(key), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return narrow.mapInArrow(run, f"`{key}` {kind}, {COLUMNS}")


def keep(docs: DataFrame, text: str = "text", bands=BANDS) -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with all their columns. No shuffle:
    the verdict is made next to the row, so rows need no key."""
    ship_package(docs.sparkSession)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for part, block in blocks(batch, batch.schema.names[place]):
                c = base_counts(block)
                failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
                fine = [not f and compression(x, compressor, bands)[3] for f, x in zip(failed, block.texts)]
                yield part.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
