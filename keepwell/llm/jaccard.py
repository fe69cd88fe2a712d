"""Similarity join of texts by Jaccard similarity of word shingles.

Two texts link if ``100 * |A and B| >= percent * |A or B|`` for their sets of
``width``-word shingles. The join finds the classes of linked texts exactly:

1. ``shingle_sets``: texts with the same set form one class, found by a 128-bit
   signature. Only classes take part in what follows, so copies cost nothing. A class is named by its set, not
   by an id: different texts under one id are different classes.
2. ``sketch``: a table of fixed size counts in how many texts the shingles of
   each hash bucket occur; it orders shingles by rarity.
3. ``postings``: each text is filed under the shingles of its prefix. A text of n
   shingles that must share c of them has ``n - c + m`` prefix shingles if partners
   have to share m of these. m is chosen for each text by the estimated cost: the
   postings to read plus the candidates to verify, of which there are at most
   (sum of the postings' lengths) / m.
4. ``stars``: in each posting list the text with the fewest rarer shingles is the
   hub; each text is compared with the hub it shares most lists with. This joins
   groups of near copies by one comparison for each member.
5. ``crossing``: every pair of texts that are not yet in one class and share at
   least m prefix shingles (m of the less demanding one) inside the prefixes and
   positions that the two sizes allow; shingles met in one class only cannot be among
   the shared ones, which settles most pairs at their first match. Nothing is capped.
6. ``verified``: pairs whose parities (an odd or even number of shingles in each of
   1,024 hash classes) differ in more places than similar sets can are dropped; for the others the size
   of the intersection is taken from the whole sets.
7. ``pairs`` and ``links``: every link lies inside a component, so the classes of each
   component are compared all with all, in blocks of at most about ``BLOCK`` classes; two blocks
   meet in one task, where numpy counts what their sets share. No link between different texts is left out.

Texts without words, and nulls, have an empty set and link with nothing. Equal
texts, ties and repeated rows fall into one class; an id that occurs with several texts has several classes. An empty table gives an empty
result. Columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from keepwell.llm.arrays import NOT_SPACE, Block, Words, blocks, mix, unused, window_hash
from keepwell.session import ship_package, written

WIDTH = 4
PERCENT = 85
MOST_MATCHES = 8
#: cost of verifying a candidate, in postings read: two whole sets travel for it
VERIFY_COST = 200.0
#: up to so many wanted texts are looked up by a broadcast of their keys; more by a shuffle
MOST_WANTED = 1_000_000
SKETCH_BITS = 18
CHUNK_BITS = 12
#: classes of a component, and shingles of these, that are compared in one task with as many others (about)
BLOCK = 128
BLOCK_SHINGLES = 1 << 18
#: numbers of 64 bits in a set's parities
PARITIES = 16

_U = np.uint64


def shingle_sets(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, by text and hash; a text of
    fewer than ``width`` words has its whole sequence as one shingle."""
    words = Words(block, NOT_SPACE, lower=True)
    at, value = words.windows(width)
    owners, values = [words.owner[at]], [value]
    for n in range(1, width):
        short = np.flatnonzero(words.count == n)
        owners.append(short)
        values.append(window_hash(words.hash, words.first[short], n))
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])][: len(value)]
    return owner[new], value[new]


def _sums(owner: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2^64 for each of ``n`` owners; ``owner`` ascends."""
    out = np.zeros(n, _U)
    if len(owner):
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[first]] = np.add.reduceat(values, first)
    return out


def signatures(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set."""
    return _sums(owner, mix(value ^ _U(0xA5A5A5A5A5A5A5A5)), n), _sums(owner, mix(value + _U(0x1234567)), n)


def parities(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """For each set ``64 * PARITIES`` bits: whether an odd number of its shingles falls to each.

    A shingle that only one of two sets holds changes one bit, so the sets differ by at least
    as many shingles as their parities differ by bits.
    """
    bits = 64 * PARITIES
    out = np.zeros((n, PARITIES), np.int64)
    edge = np.searchsorted(owner, np.arange(0, n + 1024, 1024))
    for i, first in enumerate(range(0, n, 1024)):  # a thousand texts at a time
        part = slice(edge[i], edge[i + 1])
        rows = min(1024, n - first)
        slot = (owner[part] - first) * bits + (value[part] & _U(bits - 1)).astype(np.int64)
        odd = (np.bincount(slot, minlength=rows * bits) & 1).astype(np.uint8).reshape(rows, bits)
        out[first : first + rows] = np.packbits(odd, axis=1).view(np.int64)
    return out


def members(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Per text: size, signature and parities of its set; in other rows, blobs of the sketch's counts."""
    ship_package(docs.sparkSession)
    marks = [f"b{i}" for i in range(PARITIES)]
    names = ["key", "n", "hi", "lo", *marks, "chunk", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        seen: set[tuple[int, int]] = set()
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for part, block in blocks(batch, "text"):
                owner, value = shingle_sets(block, width)
                n = np.bincount(owner, minlength=len(block))
                hi, lo = signatures(owner, value, len(block))
                new = np.zeros(len(block), bool)
                for i, s in enumerate(zip(hi.tolist(), lo.tolist())):
                    if s not in seen:
                        seen.add(s)
                        new[i] = True
                counts += np.bincount(
                    (value[new[owner]] >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts)
                )
                odd = parities(owner, value, len(block)).T
                none = pa.nulls(len(block), pa.int32()), pa.nulls(len(block), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (n, hi, lo, *odd)), *none],
                    names,
                )
        if kind is not None:
            pack, each = zstandard.ZstdCompressor(level=1), 1 << CHUNK_BITS
            chunks = [i for i in range(len(counts) // each) if counts[i * each : (i + 1) * each].any()]
            none = [pa.nulls(len(chunks), t) for t in (kind, *[pa.int64()] * (3 + PARITIES))]
            blobs = [pack.compress(counts[i * each : (i + 1) * each].tobytes()) for i in chunks]
            yield pa.RecordBatch.from_arrays(
                [*none, pa.array(chunks, pa.int32()), pa.array(blobs, pa.binary())], names
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n long, hi long, lo long, {', '.join(f'{m} long' for m in marks)}, chunk int, counts binary"
    )


def sketch(rows: DataFrame) -> np.ndarray:
    """The counts of all tasks added up; 2^SKETCH_BITS numbers, whatever the size of the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, total = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(unpack.decompress(blob), np.int64)
                total[chunk] = total[chunk] + part if chunk in total else part
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                ["chunk", "counts"],
            )

    out = np.zeros(1 << SKETCH_BITS, np.int64)
    summed = rows.where("chunk is not null").select("chunk", "counts").repartition("chunk")
    for r in summed.mapInArrow(run, "chunk int, counts binary").collect():
        out[r.chunk << CHUNK_BITS : (r.chunk + 1) << CHUNK_BITS] += np.frombuffer(r.counts, np.int64)
    return out


def prefixes(owner, value, n_texts, counts, percent, most):
    """(text, hash, size, place, matches) of the prefix shingles of each text of a block."""
    seen = counts[(value >> _U(64 - SKETCH_BITS)).astype(np.int64)]
    rank = (np.log2(seen + 1.0) * 64).astype(_U) << _U(52) | value >> _U(12)
    order = np.lexsort((rank, owner))
    owner, value, seen = owner[order], value[order], seen[order]
    size = np.bincount(owner, minlength=n_texts)
    first = np.cumsum(size) - size
    need = -(-percent * size // 100)
    usual = np.median(counts[counts > 0]) if (counts > 0).any() else 0
    total = np.r_[0.0, np.cumsum(np.maximum(seen - usual, 1.0))]
    best, matches = np.full(n_texts, np.inf), np.zeros(n_texts, np.int64)
    for m in range(1, most + 1):
        length = size - need + m
        met = total[np.minimum(first + length, len(value))] - total[first]
        cost = met + VERIFY_COST * (met - length) / m
        better = (m <= need) & (cost < best)
        best[better], matches[better] = cost[better], m
    # a smaller set cannot be similar to a different one
    matches[100 * size < percent * (size + 1)] = 0
    place = np.arange(len(value)) - first[owner]
    kept = (place < (size - need + matches)[owner]) & (matches[owner] > 0)
    owner, value, place = owner[kept], value[kept], place[kept]
    return owner, value, size[owner], place, matches[owner]


def postings(docs: DataFrame, counts: np.ndarray, key: str, text: str, width: int, percent: int, most: int):
    """(h, hi, lo, info): the classes filed under each prefix shingle. A task files a class once."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for _, block in blocks(batch, "text"):
                owner, value = shingle_sets(block, width)
                hi, lo = signatures(owner, value, len(block))
                new = np.zeros(len(block), bool)
                for i, s in enumerate(zip(hi.tolist(), lo.tolist())):
                    if s not in seen:
                        seen.add(s)
                        new[i] = True
                rows = new[owner]
                owner, value, size, place, matches = prefixes(
                    owner[rows], value[rows], len(block), shared.value, percent, most
                )
                info = size << 36 | place << 8 | matches
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.view(np.int64)) for x in (value, hi[owner], lo[owner], info)],
                    ["h", "hi", "lo", "info"],
                )

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "h long, hi long, lo long, info long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); root is the smallest node reachable.

    Each round every node takes the smallest label around it and then its label's
    label, so chains shrink by more than half. Rounds are written, not kept in lineage.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a <> b").distinct())
    labels = written(edges.groupBy("a").agg(F.min("b").alias("r")).select("a", F.least("a", "r").alias("r")))
    while True:
        around = edges.join(labels.select(F.col("a").alias("b"), "r"), "b").groupBy("a").agg(F.min("r").alias("m"))
        lower = labels.join(around, "a").select("a", "r", F.least("r", "m").alias("m"))
        jump = labels.select(F.col("a").alias("m"), F.col("r").alias("j"))
        after = written(
            lower.join(jump, "m", "left").select("a", F.col("r").alias("old"), F.least("m", "j").alias("r"))
        )
        labels = after.select("a", "r")
        if not after.where("old <> r").limit(1).count():
            return labels.select(F.col("a").alias("node"), F.col("r").alias("root"))


def sets_of(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """``wanted`` (node, key, hi, lo and more) with ``hashes``, the class's whole set: ascending 64-bit hashes.

    Texts are found by the smallest key of the class; of several texts under one key the signature tells which is meant.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch, "text"):
                owner, value = shingle_sets(block, width)
                hi, lo = signatures(owner, value, len(block))
                ends = np.cumsum(np.bincount(owner, minlength=len(block)))
                blobs = [x.tobytes() for x in np.split(value, ends[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.view(np.int64)) for x in (hi, lo)), pa.array(blobs, pa.binary())], ["hi", "lo", "hashes"]
                )

    few = wanted.limit(MOST_WANTED + 1).count() <= MOST_WANTED
    keys = wanted.select("key").distinct()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(keys) if few else keys, "key", "left_semi").select("text")
    found = rows.mapInArrow(run, "hi long, lo long, hashes binary")
    nodes = wanted.select("hi", "lo", "node")
    found = found.join(F.broadcast(nodes) if few else nodes, ["hi", "lo"]).select("node", "hashes").dropDuplicates(["node"])
    return wanted.join(found, "node")


def alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and parities do not rule a link out; the sets themselves are not needed."""
    marks = [f"b{i}" for i in range(PARITIES)]
    pairs = written(pairs)
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    one = classes.join(nodes, "node", "left_semi").select("node", "n", *marks)
    x, y = (one.withColumnsRenamed({c: f"{c}{side}" for c in one.columns}) for side in "xy")
    apart = " + ".join(f"bit_count({m}x ^ {m}y)" for m in marks)
    least = f"cast(ceil({percent} * (nx + ny) / {100 + percent}) as long)"
    both = pairs.join(x, F.col("a") == F.col("nodex")).join(y, F.col("b") == F.col("nodey"))
    return both.where(f"{apart} <= nx + ny - 2 * {least}").select("a", "b")


def verified(
    docs: DataFrame, pairs: DataFrame, classes: DataFrame, key: str, text: str, width: int, percent: int
) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; only texts of likely pairs are read out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                both = np.concatenate((x, y))
                both.sort(kind="stable")  # two ascending runs: one merge
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = written(alike(pairs, classes, percent))
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(classes.select("node", "key", "hi", "lo").join(nodes, "node", "left_semi"))
    sets = sets_of(docs, wanted, key, text, width)
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return written(full.mapInArrow(run, pairs.schema))


def _sizes(percent: int, a: str, b: str) -> str:
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _filter(percent: int, x: str, y: str) -> str:
    """What the sizes and places of one shared prefix shingle must allow; columns end in x and y.

    Of the shingles before it, at most ``before`` are in any other text's posting lists.
    """
    least = f"cast(ceil({percent} * (s{x} + s{y}) / {100 + percent}) as long)"  # shared shingles the sizes ask for
    return (
        f"100 * least(s{x}, s{y}) >= {percent} * greatest(s{x}, s{y})"
        f" and p{x} < s{x} - {least} + least(m{x}, m{y}) and p{y} < s{y} - {least} + least(m{x}, m{y})"
        f" and least(b{x}, b{y}) + least(s{x} - p{x}, s{y} - p{y}) >= {least}"
    )


def _ranked(lists: DataFrame) -> DataFrame:
    """Adds ``before``: how many posting lists the text is in for its rarer shingles."""
    earlier = Window.partitionBy("node").orderBy("place")
    return lists.withColumn("before", F.row_number().over(earlier) - 1)


def _side(lists: DataFrame, side: str, *more: str) -> DataFrame:
    return lists.select("h", *(F.col(c).alias(c[0] + side) for c in ("node", "size", "place", "matches", "before", *more)))


def stars(lists: DataFrame, percent: int) -> DataFrame:
    """For each text the hub it shares most posting lists with."""
    first = F.struct("place", F.xxhash64("node").alias("z"), "node", "size", "matches", "before")
    hubs = _side(lists.groupBy("h").agg(F.min(first).alias("u")).select("h", "u.*"), "y")
    met = _side(lists, "x").join(hubs, "h").where("nx <> ny").where(_filter(percent, "x", "y"))
    met = met.groupBy("nx", "ny").agg(F.count("*").alias("n"))
    return met.groupBy(F.col("nx").alias("a")).agg(F.max_by("ny", F.struct("n", "ny")).alias("b"))


def crossing(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of texts of different classes (column ``root``) that pass the prefix filter."""
    several = lists.groupBy("h").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p <> q").select("h")
    lists = _ranked(lists.join(several, "h", "left_semi"))
    x, y = (_side(lists, side, "root") for side in "xy")
    close = x.join(y, "h").where("rx <> ry and nx < ny").where(_filter(percent, "x", "y"))
    found = close.groupBy(F.col("nx").alias("a"), F.col("ny").alias("b")).agg(
        F.count("*").alias("n"), F.min(F.least("mx", "my")).alias("m")
    )
    return found.where("n >= m").select("a", "b")


def _linked(
    docs: DataFrame, key: str, text: str, width: int, percent: int, most: int
) -> tuple[DataFrame, DataFrame]:
    """Rows (key, n, hi, lo, node, root, component, class) and classes (node, key, hi, lo, n, root, component).

    A class is a set of shingles; ``node`` numbers it, in the order of its smallest key. Rows without
    words, and rows with a null key whose set no other row has, are in no class.
    """
    marks = [f"b{i}" for i in range(PARITIES)]
    rows = written(members(docs, key, text, width))
    texts = rows.where("chunk is null")
    counts = sketch(rows)
    same = [F.first(c).alias(c) for c in ("n", *marks)]  # they follow from the set
    found = texts.where("n > 0 and key is not null").groupBy("hi", "lo").agg(F.min("key").alias("key"), *same)
    # written, so that numbers stay and the last join has plain shuffles on both sides, where Spark can split a class of very many copies
    classes = written(found.orderBy("key", "hi", "lo").withColumn("node", F.monotonically_increasing_id()))
    filed = postings(docs, counts, key, text, width, percent, most).repartition("h")
    filed = filed.groupBy("h", "hi", "lo").agg(F.min("info").alias("info"))
    filed = filed.withColumn("n", F.count("*").over(Window.partitionBy("h"))).where("n > 1").drop("n")
    lists = written(
        filed.join(classes.select("hi", "lo", "node"), ["hi", "lo"]).select(
            "h", "node",
            F.shiftright("info", 36).alias("size"),
            F.expr("shiftright(info, 8) & 268435455").alias("place"),
            F.expr("info & 255").alias("matches"),
        )
    )
    near = verified(docs, stars(lists.withColumn("before", F.col("place")), percent), classes, key, text, width, percent)
    first = components(near)
    rooted = lists.join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    far = verified(docs, crossing(rooted, percent), classes, key, text, width, percent)
    final = components(near.union(far))
    # the smallest node of a component has its smallest key
    keys = classes.select(F.col("node").alias("root"), F.col("key").alias("component"))
    named = classes.select("node", "key", "hi", "lo", "n").join(final, "node", "left")
    named = written(named.withColumn("root", F.coalesce("root", "node")).join(keys, "root"))
    ids = named.select(*[F.col(c).alias(f"{c}_") for c in ("hi", "lo")], "node", "root", "component", F.col("key").alias("class"))
    meets = (F.col("hi") == F.col("hi_")) & (F.col("lo") == F.col("lo_")) & (F.col("n") > 0)
    return texts.join(ids, meets, "left").select("key", "n", "hi", "lo", "node", "root", "component", "class"), named


def link(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    most: int = MOST_MATCHES,
) -> DataFrame:
    """(key, n_shingles, component_id, class_id) of every row: smallest key reachable by links, and
    smallest key with the same set. Different texts under one key are told apart by their sets."""
    rows, _ = _linked(docs, key, text, width, percent, most)
    return rows.select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "key").alias("component_id"),
        F.coalesce("class", "key").alias("class_id"),
    )


def shared(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], n_x: int, n_y: int) -> np.ndarray:
    """Size of the intersection of each of ``n_x`` sets with each of ``n_y``; sets are given as (owner, value)."""
    common = np.intersect1d(x[1], y[1])
    sides = []
    for owner, value in (x, y):
        at = np.minimum(np.searchsorted(common, value), max(0, len(common) - 1))
        met = common[at] == value if len(common) else np.zeros(len(value), bool)
        owner, at = owner[met], at[met]
        order = np.argsort(at, kind="stable")
        sides.append((owner[order], at[order]))
    out, step = np.zeros((n_x, n_y), np.int64), 4096
    for first in range(0, len(common), step):
        dense = []
        for (owner, at), n in zip(sides, (n_x, n_y)):
            part = slice(*np.searchsorted(at, (first, first + step)))
            rows = np.zeros((n, step), np.float32)
            rows[owner[part], at[part] - first] = 1
            dense.append(rows)
        out += (dense[0] @ dense[1].T).astype(np.int64)  # a chunk's counts are exact in 32 bits
    return out


def _compared(
    docs: DataFrame, classes: DataFrame, key: str, text: str, width: int, percent: int, counted: bool = False
) -> DataFrame:
    """The links (a, b) between classes, by node, a < b; or (node, n), the rows that a class's links lead to,
    added up by ``copies`` where the links are found.

    Near copies of one text link all with all, so the number of links grows with the square of a component's different
    texts, and so does this: blocks of classes meet in pairs, each in one task.
    """
    groups = classes.groupBy("root").agg(F.count("*").alias("g"), F.sum("n").alias("total"))
    groups = groups.where("g > 1").select(
        "root", F.expr(f"cast(greatest(ceil(g / {BLOCK}), ceil(total / {BLOCK_SHINGLES})) as int)").alias("blocks")
    )
    wanted = written(
        classes.join(groups, "root").select(
            "node", "key", "hi", "lo", "root", "blocks", F.expr("cast(pmod(xxhash64(node), blocks) as int)").alias("block"),
            *(["copies"] if counted else []),
        )
    )
    rows = sets_of(docs, wanted, key, text, width)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "node", "hashes",
        *(["copies"] if counted else []),
    )

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x, y, block, nodes = (table.column(c).to_numpy() for c in ("x", "y", "block", "node"))
        hashes = table.column("hashes").to_pylist()
        sides = []
        for b in (x[0], y[0]):
            mine = np.flatnonzero(block == b)
            sets = [np.frombuffer(hashes[i], _U) for i in mine]
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            sides.append((mine, np.repeat(np.arange(len(sets)), n), np.concatenate(sets) if sets else np.empty(0, _U), n))
        (mine, owner, value, n), (yours, owner_, value_, n_) = sides
        both = shared((owner, value), (owner_, value_), len(mine), len(yours))
        near = 100 * both >= percent * (n[:, None] + n_[None, :] - both)
        if x[0] == y[0]:
            near = np.triu(near, 1)
        i, j = np.nonzero(near)
        if counted:
            copies = table.column("copies").to_numpy()
            n = np.zeros(len(nodes), np.int64)
            np.add.at(n, mine[i], copies[yours[j]])
            np.add.at(n, yours[j], copies[mine[i]])
            some = n > 0
            return pa.table([pa.array(nodes[some]), pa.array(n[some])], ["node", "n"])
        a, b = nodes[mine[i]], nodes[yours[j]]
        return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return rows.groupBy("root", "x", "y").applyInArrow(run, "node long, n long" if counted else "a long, b long")


def pairs(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    most: int = MOST_MATCHES,
) -> DataFrame:
    """(a, b), a <= b: every link between two classes, by their smallest keys. With the classes of
    ``link`` these are all links: texts of one class link with one another as well."""
    _, classes = _linked(docs, key, text, width, percent, most)
    names = [classes.select(F.col("node").alias(side), F.col("key").alias(f"key_{side}")) for side in "ab"]
    met = _compared(docs, classes, key, text, width, percent).join(names[0], "a").join(names[1], "b")
    return met.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))


def links(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    most: int = MOST_MATCHES,
) -> DataFrame:
    """The columns of ``link`` and ``n_links``: how many other rows the text links with. A row whose key is
    null and whose set no row with a key has is in no class, so it has and makes no links."""
    rows, classes = _linked(docs, key, text, width, percent, most)
    rows = written(rows)
    copies = written(rows.where("node is not null").groupBy("node").agg(F.count("*").alias("copies")))
    met = _compared(docs, classes.join(copies, "node"), key, text, width, percent, True)
    others = met.groupBy("node").agg(F.sum("n").alias("others"))
    # written, so that both sides of the last join are plain shuffles and Spark can split a class with very many copies
    counts = written(copies.join(others, "node", "left").select(
        F.col("node").alias("of"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("m")
    ))
    return rows.join(counts, F.col("node") == F.col("of"), "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "key").alias("component_id"),
        F.coalesce("class", "key").alias("class_id"),
        F.coalesce("m", F.lit(0)).alias("n_links"),
    )


def representatives(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    most: int = MOST_MATCHES,
) -> DataFrame:
    """One row of ``docs`` for each component of linked texts, that of the smallest key, whole.

    Rows without words, and rows with a null key, stay. Under a key that occurs several times a row stays if its
    set represents its component; of rows alike in key and set that of the least text does.
    """
    rows, _ = _linked(docs, key, text, width, percent, most)
    rows = written(rows.where("key is not null").select(F.col("key").alias(key), "hi", "lo", "node", "root", "component"))
    chosen = rows.where(F.coalesce(F.col("component") == F.col(key), F.lit(True)))
    several = written(rows.groupBy(key).count().where("count > 1").select(key))
    one = docs.join(chosen.select(key).distinct(), key, "left_semi").join(several, key, "left_anti")

    hi, lo, least = (unused(docs.columns, c) for c in ("set_hi", "set_lo", "least_text"))
    # a component's first class is its own; the other classes of its key go
    signs = chosen.join(several, key, "left_semi").where("node is null or node = root")
    signs = signs.select(key, F.col("hi").alias(hi), F.col("lo").alias(lo)).distinct()
    some = _signed(docs.join(several, key, "left_semi"), text, width, hi, lo).join(signs, [key, hi, lo], "left_semi")
    texts = some.groupBy(key, hi, lo).agg(F.min(text).alias(least))
    some = some.join(texts, [key, hi, lo]).where(F.col(text).eqNullSafe(F.col(least))).dropDuplicates([key, hi, lo])
    columns = docs.columns
    return one.select(*columns).unionByName(some.select(*columns)).unionByName(docs.where(F.col(key).isNull()))


def _signed(docs: DataFrame, text: str, width: int, hi: str, lo: str) -> DataFrame:
    """``docs`` with the signature of each text's set."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch, batch.schema.names[place]):
                signs = signatures(*shingle_sets(block, width), len(block))
                columns = [*part.columns, *(pa.array(x.view(np.int64)) for x in signs)]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, hi, lo])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(hi, LongType()), StructField(lo, LongType())]))
