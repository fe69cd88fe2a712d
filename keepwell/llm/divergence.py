"""Audit of how far the sources of a language diverge in their words.

Every (lang, source) group gives each kept term of its language a smoothed share; the audit
ranks the other sources by their distance from the group, and the terms that set the group
apart from its language. All arithmetic is on integers.

Strings are materialized late:

1. ``named_groups``: languages and groups get 64-bit numbers, seeded so that no two share one.
2. ``tally``: tasks cut texts into terms and count them under 64-bit digests. Words of one block that
   share a digest are compared byte by byte, so each row stands for one term; its text is
   stored beside the numbers, in a Parquet table whose columns are read apart.
3. ``counts``: occurrences and documents are summed by (language, group, digest); the rows that are shuffled hold
   numbers of fixed width, no text.
4. ``collisions``: the minimum and the maximum text of each digest. Where they differ the digest stands for several
   terms; it is counted anew, split by text (``split`` holds the text there and is empty elsewhere).
5. ``audit``: kept terms, shares, distances. Pairs of sources are summed in sparse form: a pair costs
   what its sources both hold, and terms that one of them lacks come from a histogram of shares.
6. Texts are joined back for the terms that are returned, and for those that tie with the last of them.

Null text, lang and source are read as empty. A text without terms counts for no term, its group still occurs.
Repeated rows are documents of their own. Equal values are ranked by the item's UTF-8 bytes. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.llm.arrays import Block, Words, _class, blocks, ragged
from keepwell.session import ship_package, written

LEAST_DOCUMENTS = 10
TERMS = 10
SCALE = 1_000_000_000
#: bytes of text that are counted together in a task
TALLY_BYTES = 4 << 20
DIGEST_BITS = 64

#: terms are runs of ASCII letters and non-ASCII characters
LETTERS = _class(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

TALLY = "lid long, gid long, digest long, term string, n long, docs long"


def _strings(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The slices ``data[start : start + size]`` as an Arrow string array."""
    ends = np.r_[0, np.cumsum(size)].astype(np.int32)
    body = np.ascontiguousarray(data[ragged(start, size)])
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(body)])


def _distinct(data: np.ndarray, words: Words, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word's term, a word of each term); equal numbers mean equal bytes."""
    _, first, term = np.unique(digest, return_index=True, return_inverse=True)
    size = words.end - words.start
    model = first[term]
    same = size == size[model]
    at = np.flatnonzero(same)
    odd = data[ragged(words.start[at], size[at])] != data[ragged(words.start[model[at]], size[at])]
    same[np.repeat(at, size[at])[odd]] = False
    if same.all():
        return term, first
    # some digest stands for several terms: number the words that are not their model's term by their bytes
    number, models = {}, list(first)
    term = term.copy()
    for i in np.flatnonzero(~same):
        key = (int(digest[i]), data[words.start[i] : words.end[i]].tobytes())
        if key not in number:
            number[key] = len(models)
            models.append(i)
        term[i] = number[key]
    return term, np.array(models)


def named_groups(docs: DataFrame, lang: str, source: str) -> tuple[DataFrame, int]:
    """lang, source, lid, gid of every occurring group, and the seed that keeps the numbers apart."""
    for seed in count():
        names = docs.select(_plain(lang).alias("lang"), _plain(source).alias("source"))
        groups = written(names.distinct().select("*", *_numbers(F.col("lang"), F.col("source"), seed)))
        seen = groups.agg(
            F.count(F.lit(1)), F.count_distinct("gid"), F.count_distinct("lang"), F.count_distinct("lid")
        ).first()
        if seen[0] == seen[1] and seen[2] == seen[3]:
            return groups, seed


def _plain(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _numbers(lang: Column, source: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), lang).alias("lid"), F.xxhash64(F.lit(seed), lang, source).alias("gid")]


def tally(docs: DataFrame, lang: str, source: str, text: str, seed: int = 0, bits: int = DIGEST_BITS) -> DataFrame:
    """One row per block, group and term: its digest, text, occurrences and documents."""
    ship_package(docs.sparkSession)
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch, "text", TALLY_BYTES):
                yield _tallied(part, block, mask)

    numbers = _numbers(_plain(lang), _plain(source), seed)
    return docs.select(*numbers, _plain(text).alias("text")).mapInArrow(run, TALLY)


def _tallied(part: pa.RecordBatch, block: Block, mask: np.uint64) -> pa.RecordBatch:
    words = Words(block, LETTERS, lower=True)
    data = _LOWER[block.data]
    digest = words.hash & mask
    term, model = _distinct(data, words, digest)
    lid, gid = (part.column(i).to_numpy() for i in (0, 1))
    _, one, group = np.unique(gid, return_index=True, return_inverse=True)
    cell = term * np.int64(len(one)) + group[words.owner]
    order = np.argsort(cell, kind="stable")  # words of a text stay together
    cell, owner = cell[order], words.owner[order]
    new = np.r_[True, cell[1:] != cell[:-1]][: len(cell)]
    first = np.flatnonzero(new)
    fresh = new | np.r_[True, owner[1:] != owner[:-1]][: len(cell)]
    n = np.diff(np.r_[first, len(cell)])
    seen = np.add.reduceat(fresh.astype(np.int64), first) if len(first) else np.empty(0, np.int64)
    mine = one[group[owner[first]]]
    size = words.end - words.start
    texts = _strings(data, words.start[model], size[model])
    columns = [
        pa.array(lid[mine]),
        pa.array(gid[mine]),
        pa.array(digest[order[first]].view(np.int64)),
        texts.take(pa.array(term[order[first]])),
        pa.array(n.astype(np.int64)),
        pa.array(seen),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lid", "gid", "digest", "term", "n", "docs"])


def counts(tallied: DataFrame) -> DataFrame:
    """lid, gid, digest, split, n, docs: exact counts, although digests may collide.

    Rows are combined by block already and lie together by term, so they travel as they are, dealt out by
    language and term: sums of groups and, after them, of languages need no further shuffle.
    """
    sums = [F.sum("n").alias("n"), F.sum("docs").alias("docs")]
    several = written(collisions(tallied).select("digest"))
    dealt = tallied.select("lid", "gid", "digest", "n", "docs").repartition("lid", "digest")
    single = dealt.groupBy("lid", "gid", "digest").agg(*sums).join(several, "digest", "left_anti")
    split = tallied.join(several, "digest", "left_semi").groupBy("lid", "gid", "digest", F.col("term").alias("split"))
    return single.withColumn("split", F.lit("")).unionByName(split.agg(*sums))


def collisions(tallied: DataFrame) -> DataFrame:
    """digest, least, most: the digests that stand for several terms."""
    ends = tallied.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))
    return ends.filter("least < most")


def share(n: str, total: str, kept: str) -> str:
    """SQL of 1 + floor(SCALE * (n + 2) / (total + 2 * kept)); decimals, as the product may pass 64 bits."""
    above = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + 2 AS DECIMAL(20,0))"
    return f"CASE WHEN {kept} > 0 THEN 1 + ({above}) DIV CAST({total} + 2 * {kept} AS DECIMAL(20,0)) END"


def distance(p: str, q: str) -> str:
    """SQL of floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so the square has 60 bits."""
    return f"((({p}) - ({q})) * (({p}) - ({q}))) DIV (({p}) + ({q}))"


def _both(shares: DataFrame) -> DataFrame:
    """gid, item, value: what terms that both groups hold add beyond the one-sided sums.

    A task reads the groups of one term after another and sums pairs of them; of a batch of rows it gives
    one row for each pair of groups that meets in it.
    """
    ship_package(shares.sparkSession)

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def summed(run: np.ndarray, gid: np.ndarray, p: np.ndarray, base: np.ndarray) -> pa.RecordBatch | None:
        ids, number = np.unique(gid, return_inverse=True)
        codes, values = [], []
        for step in range(1, len(run)):
            a = np.flatnonzero(run[:-step] == run[step:])
            if not len(a):
                break
            b = a + step
            extra = f(p[a], p[b]) - f(p[a], base[b]) - f(base[a], p[b]) + f(base[a], base[b])
            code, place = np.unique(number[a] * np.int64(len(ids)) + number[b], return_inverse=True)
            total = np.zeros(len(code), np.int64)
            np.add.at(total, place, extra)
            codes.append(code)
            values.append(total)
        if not codes:
            return None
        code, value = np.concatenate(codes), np.concatenate(values)
        columns = [pa.array(ids[code // len(ids)]), pa.array(ids[code % len(ids)]), pa.array(value)]
        return pa.RecordBatch.from_arrays(columns, ["gid", "item", "value"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if not table.num_rows:
                continue
            lid, digest, gid, p, base = (table.column(c).to_numpy() for c in ("lid", "digest", "gid", "p", "base"))
            split = table.column("split").combine_chunks().dictionary_encode().indices.to_numpy()
            new = (lid[1:] != lid[:-1]) | (digest[1:] != digest[:-1]) | (split[1:] != split[:-1])
            run = np.r_[0, np.cumsum(new)]
            # the last term may go on in the next batch
            cut = int(np.searchsorted(run, run[-1]))
            rest = table.slice(cut).to_batches()[0]
            if cut and (out := summed(run[:cut], gid[:cut], p[:cut], base[:cut])) is not None:
                yield out
        if rest is not None:
            last = [rest.column(rest.schema.get_field_index(c)).to_numpy() for c in ("gid", "p", "base")]
            if (out := summed(np.zeros(rest.num_rows), *last)) is not None:
                yield out

    # the language is part of the key, so one term's rows are its language's groups at most
    dealt = shares.repartition("lid", "digest", "split").sortWithinPartitions("lid", "digest", "split", "gid")
    found = dealt.mapInArrow(pairs, "gid long, item long, value long")
    once = found.groupBy("gid", "item").agg(F.sum("value").alias("value"))
    return once.unionByName(once.select(F.col("item").alias("gid"), F.col("gid").alias("item"), "value"))


def audit(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least: int = LEAST_DOCUMENTS,
    terms: int = TERMS,
    bits: int = DIGEST_BITS,
) -> DataFrame:
    """lang, source, part, item, value, rank: other sources by distance, and distinctive terms.

    ``bits`` is the width of the digests; fewer collide more often and give the same result.
    """
    named, seed = named_groups(docs, lang, source)
    tallied = written(tally(docs, lang, source, text, seed, bits))
    counted = written(counts(tallied))

    term = ["lid", "digest", "split"]
    kept = counted.groupBy(*term).agg(F.sum("n").alias("overall"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    held = written(counted.drop("docs").join(kept.drop("docs"), term))
    # each kept term of a language counts once in V and with all its occurrences in N
    lone = held.groupBy(*term).agg(F.first("overall").alias("overall"))
    sizes = lone.groupBy("lid").agg(F.count(F.lit(1)).alias("kept"), F.sum("overall").alias("lang_total"))
    totals = held.groupBy("gid").agg(F.sum("n").alias("total"))
    groups = written(
        named.select("lid", "gid").join(sizes, "lid", "left").join(totals, "gid", "left")
        .fillna(0, ["kept", "lang_total", "total"])
        .withColumn("base", F.expr(share("0", "total", "kept")))
    )
    shares = held.join(groups.drop("lid"), "gid").withColumn("p", F.expr(share("n", "total", "kept")))

    # pairs of sources: all kept terms at the shares of a count of 0, then what counts above 0 change
    other = groups.select("lid", F.col("gid").alias("item"), F.col("base").alias("other"))
    both = groups.join(other, "lid").filter("gid <> item").select("gid", "item", "kept", "base", "other")
    none = both.withColumn("value", F.coalesce(F.expr(f"kept * ({distance('base', 'other')})"), F.lit(0)).cast("long"))
    seen = shares.groupBy("gid", "p").agg(F.count(F.lit(1)).alias("times"))
    one = seen.join(both, "gid").groupBy("gid", "item").agg(
        F.expr(f"sum(times * ({distance('p', 'other')} - {distance('base', 'other')}))").alias("value")
    )
    mirrored = one.select(F.col("item").alias("gid"), F.col("gid").alias("item"), "value")
    columns = ["gid", "item", "value"]
    value = none.select(columns).unionByName(one).unionByName(mirrored).unionByName(_both(shares.select(*term, "gid", "p", "base")))
    name_of = named.select(F.col("gid").alias("item"), F.col("source").alias("_name"))
    pair = value.groupBy("gid", "item").agg(F.sum("value").alias("value"))
    pair = pair.join(name_of, "item").select("gid", F.col("_name").alias("item"), "value")

    # terms: the foremost by number alone, ties included, before any text is read
    raised = shares.withColumn("q", F.expr(share("overall", "lang_total", "kept"))).filter("p > q")
    raised = raised.withColumn("value", F.expr(distance("p", "q")).cast("long"))
    first = Window.partitionBy("gid").orderBy(F.desc("value"))
    foremost = raised.withColumn("_place", F.rank().over(first)).filter(F.col("_place") <= terms)
    foremost = written(foremost.select("gid", "digest", "split", "value"))
    wanted = foremost.filter("split = ''").select("digest").distinct()
    texts = tallied.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.min("term").alias("text"))
    found = foremost.join(texts, "digest", "left").withColumn("item", F.expr("CASE WHEN split = '' THEN text ELSE split END"))

    order = Window.partitionBy("gid").orderBy(F.desc("value"), "item")
    pair, found = (
        x.select(columns).withColumn("part", F.lit(part)).withColumn("rank", F.row_number().over(order))
        for part, x in (("pair", pair), ("term", found))
    )
    ranked = pair.unionByName(found.filter(F.col("rank") <= terms))
    return ranked.join(named.drop("lid"), "gid").select("lang", "source", "part", "item", "value", "rank")
