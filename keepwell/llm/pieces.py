"""Encoding with a SentencePiece BPE vocabulary, with seeded merge-dropout, and decoding.

Text is encoded as the library does: spaces become a visible mark, one more mark is
put in front, and the best-scoring adjacent pair of pieces is merged again and again
(leftmost first among equals). A candidate merge is skipped with probability
``dropout``, decided by a hash of the seed, the document's key, the unit's text and number, and the
places where the two pieces begin, meet and end. So a seed always gives the same
segmentation, whatever the partitions and retries, another seed another one, and
dropout 0 gives the library's own encoding.

No piece holds the mark after another character (checked when the model is loaded), so
no merge crosses from a word to the mark after it: a text falls into units, a run of
marks with the characters that follow. Every occurrence of a unit draws its own skips. Equal
units of a block are merged once without dropout; an occurrence for which none of the
candidates met on that way is skipped has the same pieces, all others are merged on their own,
side by side in numpy. A unit that is longer than ``WIDEST`` goes through an ordinary agenda.

Characters without a piece, and the mark itself where a text holds it, become byte pieces,
so that every text decodes to itself. Nulls and empty texts have no pieces; a null stays
null in ``transcribe``. Repeated rows with one key get equal pieces; rows with a null key
share one. An empty table gives an empty result. Other columns are not touched.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from keepwell.llm.arrays import blocks, mix, ragged, spans_hash, unused
from keepwell.session import ship_package

DROPOUT = 0.1
SEED = 13
WIDEST = 64
MARK = "▁"

_U = np.uint64
_NEVER = np.int32(2**31 - 1)


class Model:
    """Pieces, merges and bytes of a vocabulary file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.size = n = sp.vocab_size()
        plain, self.byte = {}, {}
        self.bytes: list[bytes] = [b""] * (n + 1)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.bytes[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                plain[piece] = i
                self.bytes[i] = piece.replace(MARK, " ").encode()
        if len(self.byte) != 256 or any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("the model needs byte pieces, and marks only in front")
        order = sorted(plain.values(), key=lambda i: (-sp.get_score(i), i))
        self.piece_of_rank = np.array(order, np.int32)
        rank = {i: r for r, i in enumerate(order)}
        self.merges = {
            (plain[p[:k]], plain[p[k:]]): rank[i]
            for p, i in plain.items()
            for k in range(1, len(p))
            if p[:k] in plain and p[k:] in plain
        }
        left, right = (np.array([pair[s] for pair in self.merges], np.int64) for s in (0, 1))
        key = left * (n + 1) + right
        sort = np.argsort(key)
        self.keys, self.ranks = key[sort], np.fromiter(self.merges.values(), np.int32, len(key))[sort]
        self.flags = np.zeros(1 << 22, bool)
        slot = self._slot(self.keys)
        self.flags[slot] = True
        # the key's number by its slot; keys that share a slot with others are searched for
        self.number = np.zeros(1 << 22, np.int32)
        self.number[slot] = np.arange(len(slot))
        self.alone = len(np.unique(slot)) == len(slot)
        self.unknown = n  # the symbol of a character without a piece
        self.symbol = np.full(0x110000, n, np.int32)
        for p, i in plain.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        self.symbol[ord(" ")] = plain[MARK]
        self.symbol[ord(MARK)] = n
        lengths = np.array([len(b) for b in self.bytes])
        self.byte_ids = np.array([self.byte[b] for b in range(256)], np.int32)
        self.piece_bytes = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.piece_length, self.piece_start = lengths, np.cumsum(lengths) - lengths

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(_U) * _U(0x9E3779B97F4A7C15) >> _U(42)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair merges into, ``_NEVER`` if none."""
        key = left.astype(np.int64) * (self.size + 1) + right
        out = np.full(len(key), _NEVER, np.int32)
        slot = self._slot(key)
        at = np.flatnonzero(self.flags[slot])
        key = key[at]
        number = self.number[slot[at]]
        if not self.alone and len(other := np.flatnonzero(self.keys[number] != key)):
            number[other] = np.minimum(np.searchsorted(self.keys, key[other]), len(self.keys) - 1)
        out[at] = np.where(self.keys[number] == key, self.ranks[number], _NEVER)
        return out


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    return Model(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def skipped(unit: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the keyed hash skips each candidate; ``unit`` carries seed, key, number and text."""
    place = (start.astype(_U) << _U(42)) ^ (middle.astype(_U) << _U(21)) ^ end.astype(_U)
    return mix(unit ^ mix(place + _U(1))) >> _U(11) < _U(int(dropout * (1 << 53)))


def agenda(symbols: list[int], unit: int, model: Model, dropout: float) -> list[tuple[int, int]]:
    """(piece, place of its first character) of one unit, by an ordinary priority queue."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(a: int) -> None:
        b = after[a]
        if a >= 0 and b < n and (r := model.merges.get((symbols[a], symbols[b]))) is not None:
            spot = (np.array([x], _U) for x in (a, b, after[b]))
            if not dropout or not skipped(np.array([unit], _U), *spot, dropout)[0]:
                heapq.heappush(heap, (r, a, b, symbols[a], symbols[b]))

    for i in range(n - 1):
        offer(i)
    while heap:
        r, a, b, x, y = heapq.heappop(heap)
        if not alive[a] or b >= n or not alive[b] or after[a] != b or (symbols[a], symbols[b]) != (x, y):
            continue
        symbols[a] = int(model.piece_of_rank[r])
        alive[b], after[a] = False, after[b]
        if after[b] < n:
            before[after[b]] = a
        if before[a] >= 0:
            offer(before[a])
        offer(a)
    return [(symbols[i], i) for i in range(n) if alive[i]]


def _merge(symbols: np.ndarray, size: np.ndarray, unit: np.ndarray, model: Model, dropout: float, met: list | None):
    """Rows of symbols (``size`` of them used) merged side by side: (symbols, places, sizes).
    All candidates met are added to ``met`` as (row, start, middle, end)."""
    n, width = symbols.shape
    number = np.arange(n)
    place = np.tile(np.arange(width + 1, dtype=np.int32), (n, 1))
    place = np.minimum(place, size[:, None])
    column = np.arange(width)

    def candidates(rows: np.ndarray, k: np.ndarray, symbols, place, size, unit) -> np.ndarray:
        """Ranks of the pairs at ``k`` of the given rows; none where there is no such pair."""
        out = np.full(len(rows), _NEVER, np.int32)
        real = (k >= 0) & (k + 1 < size[rows])
        r, c = rows[real], k[real]
        rank = model.rank(symbols[r, c], symbols[r, c + 1])
        if met is not None:
            some = np.flatnonzero(rank < _NEVER)
            a, b = r[some], c[some]
            met.append((number[a], place[a, b], place[a, b + 1], place[a, b + 2]))
        if dropout:
            some = np.flatnonzero(rank < _NEVER)
            a, b = r[some], c[some]
            lost = skipped(unit[a], place[a, b], place[a, b + 1], place[a, b + 2], dropout)
            rank[some[lost]] = _NEVER
        out[real] = rank
        return out

    rows = np.repeat(np.arange(n), width - 1) if width > 1 else np.empty(0, np.int64)
    rank = candidates(rows, np.tile(column[: width - 1], n), symbols, place, size, unit).reshape(n, width - 1)
    rank = np.concatenate((rank, np.full((n, 1), _NEVER, np.int32)), axis=1)
    done_symbols, done_place, done_size = symbols.copy(), place.copy(), size.copy()
    while len(number):
        k = rank.argmin(axis=1)
        rows = np.arange(len(number))
        found = rank[rows, k]
        more = found < _NEVER
        if not more.all():
            ended = number[~more]
            done_symbols[ended, :width], done_place[ended, : width + 1] = symbols[~more], place[~more]
            done_size[ended] = size[~more]
            number, symbols, place, size, rank, unit = (x[more] for x in (number, symbols, place, size, rank, unit))
            k, found, rows = k[more], found[more], np.arange(len(number))
            if not len(number):
                break
        symbols[rows, k] = model.piece_of_rank[found]
        # every row loses the place after its merge, so all get narrower by one
        kept = np.ones((len(rows), width + 1), bool)
        kept[rows, k + 1] = False
        place = place[kept].reshape(-1, width)
        kept = np.flatnonzero(kept[:, :width])
        symbols, rank = (x.ravel().take(kept).reshape(-1, width - 1) for x in (symbols, rank))
        width -= 1
        size = size - 1
        rank[rows, k] = candidates(rows, k, symbols, place, size, unit)
        left = rows[k > 0]
        rank[left, k[left] - 1] = candidates(left, k[left] - 1, symbols, place, size, unit)
    return done_symbols, done_place, done_size


def _utf8_size(code: np.ndarray) -> np.ndarray:
    return 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)


def _units(code, start, size, unit, model: Model, dropout: float, met: list | None = None):
    """(piece ids, places of their first characters, numbers of their units) of the units, by unit."""
    ids, origin, which = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    least = 0
    for width in (4, 8, 16, 32, WIDEST):
        rows = np.flatnonzero((size > least) & (size <= width))
        least = width
        for part in np.array_split(rows, max(1, len(rows) * width // (1 << 19))):
            if not len(part):
                continue
            at = start[part][:, None] + np.arange(width)
            table = model.symbol[code[np.minimum(at, len(code) - 1)]]
            found = None if met is None else []
            symbols, place, n = _merge(table, size[part], unit[part], model, dropout, found)
            if met is not None:
                met += [(part[row], *places) for row, *places in found]
            used = np.arange(width)[None, :] < n[:, None]
            ids.append(symbols[used])
            origin.append((start[part][:, None] + place[:, :width])[used])
            which.append(np.repeat(part, n))
    for row in np.flatnonzero(size > WIDEST).tolist():
        s = int(start[row])
        found = agenda(model.symbol[code[s : s + size[row]]].tolist(), int(unit[row]), model, dropout)
        ids.append(np.array([x for x, _ in found], np.int32))
        origin.append(np.array([s + i for _, i in found], np.int64))
        which.append(np.full(len(found), row))
    ids, origin, which = np.concatenate(ids), np.concatenate(origin), np.concatenate(which)
    sort = np.argsort(which, kind="stable")
    return ids[sort], origin[sort], which[sort]


def _skips(met: list, text: np.ndarray, n: int, unit: np.ndarray, dropout: float) -> np.ndarray:
    """Whether any candidate that the unit's text (one of ``n``) meets without dropout is skipped for the unit."""
    row, *places = (np.concatenate(x) for x in zip(*met)) if met else [np.empty(0, np.int64)] * 4
    order = np.argsort(row, kind="stable")
    places = [x[order] for x in places]
    count = np.bincount(row, minlength=n)
    first, out = np.cumsum(count) - count, np.zeros(len(unit), bool)
    for part in np.array_split(np.arange(len(unit)), max(1, len(unit) >> 16)):
        each = count[text[part]]
        at, owner = ragged(first[text[part]], each), np.repeat(part, each)
        out[owner[skipped(unit[owner], *(x[at] for x in places), dropout)]] = True
    return out


def encode(texts: list[str], keys: list, model: Model, dropout: float = DROPOUT, seed: int = SEED):
    """(all piece ids in order, number of ids of each text)."""
    full = [" " + t if t else "" for t in texts]
    code = np.frombuffer("".join(full).encode("utf-32-le"), np.uint32)
    length = np.fromiter(map(len, full), np.int64, len(full))
    if not len(code):
        return np.empty(0, np.int32), np.zeros(len(full), np.int64)
    finish = np.cumsum(length)
    space = code == 32
    opens = space.copy()
    opens[1:] &= ~space[:-1]
    opens[(finish - length)[length > 0]] = True
    begin = np.flatnonzero(opens)
    end = np.r_[begin[1:], len(code)]
    owner = np.searchsorted(finish, begin, "right")
    units = np.bincount(owner, minlength=len(full))
    number = np.arange(len(begin)) - (np.cumsum(units) - units)[owner]
    unit = spans_hash(mix(code.astype(_U) + _U(1)), begin, end)
    size = end - begin
    value, first, inverse = np.unique(unit, return_index=True, return_inverse=True)
    if dropout:
        keyed = np.array([xxhash.xxh64_intdigest(str(k), seed) for k in keys], _U)
        variant = mix(keyed[owner] + number.astype(_U))
        unit = mix(unit ^ mix(variant + _U(seed << 8) + _U(1)))
        short = size[first] <= WIDEST
        kept, met = first[short], []
        ids, origin, which = _units(code, begin[kept], size[kept], value[short], model, 0.0, met)
        text = (np.cumsum(short) - 1)[inverse]
        own = ~short[inverse]
        some = np.flatnonzero(~own)
        own[some] = _skips(met, text[some], len(kept), unit[some], dropout)
        rows = np.flatnonzero(own)
        more = _units(code, begin[rows], size[rows], unit[rows], model, dropout)
        ids, origin, which = (np.concatenate(x) for x in zip((ids, origin, which), (*more[:2], more[2] + len(kept))))
        inverse = np.where(own, len(kept) + np.cumsum(own) - 1, text)
        n = len(kept) + len(rows)
    else:
        n = len(value)
        ids, origin, which = _units(code, begin[first], size[first], value, model, dropout)
    count = np.bincount(which, minlength=n)

    lost = np.flatnonzero(ids == model.unknown)
    if len(lost):  # spelled as bytes
        spread = np.ones(len(ids), np.int64)
        spread[lost] = _utf8_size(code[origin[lost]])
        count = np.rint(np.bincount(which, spread, minlength=n)).astype(np.int64)
        ids = np.repeat(ids, spread)
        spelled = np.frombuffer(code[origin[lost]].tobytes().decode("utf-32-le").encode(), np.uint8)
        ids[ids == model.unknown] = model.byte_ids[spelled]
    each = count[inverse]
    return ids[ragged((np.cumsum(count) - count)[inverse], each)], np.rint(
        np.bincount(owner, each, minlength=len(full))
    ).astype(np.int64)


def decode(ids: np.ndarray, sizes: np.ndarray, model: Model) -> list[bytes]:
    """UTF-8 of each text, from the ids of all texts and their numbers."""
    length = model.piece_length[ids]
    data = model.piece_bytes[ragged(model.piece_start[ids], length)].tobytes()
    ends = np.r_[0, np.cumsum(length)][np.cumsum(sizes)]
    starts = np.r_[0, ends[:-1]]
    return [data[s + (e > s) : e] for s, e in zip(starts.tolist(), ends.tolist())]  # without the first mark


def _parts(batch: pa.RecordBatch, place: int, path: str, dropout: float, seed: int, key: int):
    model = load(path)
    for part, block in blocks(batch, batch.schema.names[place]):
        texts = [t.decode() for t in block.texts]
        ids, sizes = encode(texts, part.column(key).to_pylist(), model, dropout, seed)
        yield part, block, ids, sizes, decode(ids, sizes, model)


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))


def pieces(docs: DataFrame, key="doc_id", text="text", path=None, dropout=DROPOUT, seed=SEED) -> DataFrame:
    """Per text: its piece ids, their number and checksum, and whether they decode to the text."""
    ship_package(docs.sparkSession)
    path = path or default_path()
    names = [key, "ids", "n_tokens", "ids_crc32", "lossless"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block, ids, sizes, back in _parts(batch, 1, path, dropout, seed, 0):
                ends = np.cumsum(sizes)
                sums = [zlib.crc32(ids[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends, sizes)]
                same = [a == b for a, b in zip(back, block.texts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        _lists(ids, sizes),
                        pa.array(sizes),
                        pa.array(sums, pa.int64()),
                        pa.array(same, pa.bool_()),
                    ],
                    names,
                )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, ids array<int>, n_tokens long, ids_crc32 long, lossless boolean")


def transcribe(
    docs: DataFrame, key="doc_id", text="text", path=None, dropout=DROPOUT, seed=SEED, name="ids"
) -> DataFrame:
    """``docs`` with the text as its pieces decode it, and the pieces in a last column ``name``; where
    the input has a column of that name, underscores before it tell them apart."""
    ship_package(docs.sparkSession)
    name = unused(docs.columns, name)
    path = path or default_path()
    place, at = docs.columns.index(text), docs.columns.index(key)
    schema = StructType([*docs.schema.fields, StructField(name, ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, ids, sizes, back in _parts(batch, place, path, dropout, seed, at):
                old = part.column(place)
                new = pa.array([b.decode() for b in back], old.type, mask=np.array(old.is_null()))
                columns = [*part.columns, _lists(ids, sizes)]
                columns[place] = new
                yield pa.RecordBatch.from_arrays(columns, [*schema.names])

    return docs.mapInArrow(run, schema)
