"""Language of texts by a linear-chain conditional random field over their words.

Each word has features: its first and last letters, all runs of two to four bytes with
the word's bounds, and the word itself as a lexicon entry, hashed into a table of
weights for each language. Learned transitions tie neighbouring words together, so that words of
code-switched texts are labelled by their surroundings too. Forward-backward gives
every word's probabilities; a text gets the language with the largest expected number of words,
and as score that share.

The model is fitted by maximum likelihood on a sample of ``SAMPLE`` labelled texts of each language
at most, of which up to ``PIECES`` runs of ``RUN`` words are taken from anywhere in the text. Sequences
join runs of different languages, so that transitions between languages are met. Texts set aside
(``held_out``) and texts without a label never enter. Only the text is an input of a prediction.

The chain is computed for a whole block of texts at once and exactly: transfer matrices of runs
of words, then the runs of each text in order, then the words inside each run.

A null text, one without a letter, and any text if nothing could be learned get ``und`` and
score 0. Equal probabilities prefer the label that sorts first. Repeated rows get equal
results; an empty table gives an empty result. Columns other than key, text and label are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keepwell.llm.arrays import Block, Words, _class, blocks, byte_codes, mix, ragged, spans_hash
from keepwell.session import ship_package

SAMPLE = 300
PIECES = 6
RUN = 48
TABLE_BITS = 17
STRIDE = 32

UNKNOWN = "und"
LETTERS = _class(lambda b: 97 <= b <= 122 or 65 <= b <= 90 or b >= 128)
_HAS_LETTER = re.compile(r"[^\W\d_]")
_U = np.uint64


def lowered(block: Block) -> Block:
    return Block([t.decode().lower().encode() for t in block.texts])


def word_features(block: Block, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers of all words one after another, number of each word's features)."""
    size = end - start
    # the words with a bound on either side, as one array of codes
    codes = byte_codes(True)[block.data]
    padded = size + 2
    first = np.cumsum(padded) - padded
    text = np.full(int(padded.sum()), _U(0x51ED270B), _U)
    text[ragged(first + 1, size)] = codes[ragged(start, size)]
    found, owner = [], []
    of = np.repeat(np.arange(len(size)), padded)

    def add(value: np.ndarray, word: np.ndarray, kind: int) -> None:
        found.append((mix(value + _U(kind)) >> _U(64 - TABLE_BITS)).astype(np.int32))
        owner.append(word)

    run = text.copy()
    for n in range(2, 5):  # runs of n bytes, bounds included
        run = run[:-1] * _U(0x9E3779B97F4A7C15) + text[n - 1 :]
        inside = of[: len(run)] == of[n - 1 :]
        add(run[inside], of[: len(run)][inside], n)
    words = np.arange(len(size))
    for n in range(1, 4):
        long = np.flatnonzero(size >= n)
        add(spans_hash(codes, start[long], start[long] + n), long, 10 + n)
        add(spans_hash(codes, end[long] - n, end[long]), long, 20 + n)
    add(spans_hash(codes, start, end), words, 30)
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.bincount(owners, minlength=len(size))


def summed(weights: np.ndarray, numbers: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of the weights' rows of each word; every word has features."""
    if not len(count):
        return np.zeros((0, weights.shape[1]), weights.dtype)
    return np.add.reduceat(weights[numbers], np.cumsum(count) - count, axis=0)


class FeatureWords(Words):
    """Words with the features of the distinct ones."""

    def __init__(self, block: Block):
        block = lowered(block)
        super().__init__(block, LETTERS, lower=True)
        _, first, self.kind = np.unique(self.hash, return_index=True, return_inverse=True)
        self.numbers, self.features = word_features(block, self.start[first], self.end[first])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return summed(weights, self.numbers, self.features)[self.kind]


def marginals(scores: np.ndarray, count: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, ...]:
    """Probabilities of the labels of all words of texts with ``count`` words each; also each
    word's forward weights, and its own times its backward weights, up to a factor for each word."""
    n, k = scores.shape
    if not n:
        return (np.zeros((0, k)),) * 3
    local = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    move = np.exp(transition - transition.max())
    # runs of STRIDE words; the last of a text may be shorter
    runs = -(-count // STRIDE)
    begin = np.repeat(np.cumsum(count) - count, runs) + STRIDE * ragged(np.zeros(len(runs), np.int64), runs)
    size = np.minimum(STRIDE, np.repeat(np.cumsum(count), runs) - begin)
    total = len(begin)
    steps = np.arange(STRIDE)
    place = np.minimum(begin[:, None] + steps, n - 1)
    used = steps[None, :] < size[:, None]

    product = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(STRIDE):
        on = used[:, t]
        step = product[on] @ move * local[place[on, t]][:, None, :]
        product[on] = step / step.max(axis=(1, 2), keepdims=True)

    # the runs of each text in order, texts side by side
    first = np.cumsum(runs) - runs
    ahead, behind = np.ones((total, k)), np.ones((total, k))
    order = np.argsort(-runs, kind="stable")
    live, ranked = order, runs[order]
    for r in range(1, int(runs.max()) if len(runs) else 0):
        live = order[: np.searchsorted(-ranked, -r)]  # texts with more than r runs
        at = first[live] + r
        vector = np.einsum("ij,ijk->ik", ahead[at - 1], product[at - 1])
        ahead[at] = vector / vector.max(axis=1, keepdims=True)
        at = first[live] + runs[live] - 1 - r
        vector = np.einsum("ijk,ik->ij", product[at + 1], behind[at + 1])
        behind[at] = vector / vector.max(axis=1, keepdims=True)

    forward = np.empty((n, k))
    vector = ahead
    for t in range(STRIDE):
        on = np.flatnonzero(used[:, t])
        step = vector[on] @ move * local[place[on, t]]
        step /= step.max(axis=1, keepdims=True)
        forward[place[on, t]] = step
        vector[on] = step
    out, later = np.empty((n, k)), np.empty((n, k))
    vector = behind
    for t in range(STRIDE - 1, -1, -1):
        on = np.flatnonzero(used[:, t])
        both = forward[place[on, t]] * vector[on]
        out[place[on, t]] = both / both.sum(axis=1, keepdims=True)
        later[place[on, t]] = vector[on] * local[place[on, t]]
        step = later[place[on, t]] @ move.T
        vector[on] = step / step.max(axis=1, keepdims=True)
    return out, forward, later


def fit(runs: list[tuple[str, str]], rounds: int = 30, rate: float = 0.5, decay: float = 1e-4):
    """(labels, weights, transitions) from (label, words) runs."""
    labels = sorted({label for label, _ in runs})
    if not labels:
        return [], np.zeros((0, 0)), np.zeros((0, 0))
    # every run is followed by a part of the next one in an order by hash, mostly of another language
    order = np.argsort(mix(np.arange(len(runs), dtype=_U) + _U(7)))
    words = FeatureWords(Block([runs[i][1].encode() for i in order]))
    number = {label: i for i, label in enumerate(labels)}
    of_run = np.array([number[runs[i][0]] for i in order])
    truth = of_run[words.owner]
    pairs = -(-len(runs) // 2)
    count = np.bincount(words.owner // 2, minlength=pairs)  # two runs in a sequence
    k, n = len(labels), len(truth)
    if not n:
        return [], np.zeros((0, 0)), np.zeros((0, 0))
    gold = np.zeros((n, k))
    gold[np.arange(n), truth] = 1
    starts = np.zeros(n, bool)
    starts[(np.cumsum(count) - count)[count > 0]] = True
    follows = np.flatnonzero(~starts)
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[follows - 1], truth[follows]), 1)
    transition = np.log((seen + 1) / (seen + 1).sum(axis=1, keepdims=True))  # start; refined below
    weights = np.zeros((1 << TABLE_BITS, k), np.float32)
    speed, pace = np.full_like(weights, 1e-6), np.full((k, k), 1e-6)
    of_kind = np.repeat(np.arange(len(words.features)), words.features)
    kinds = len(words.features)
    for _ in range(rounds):
        scores = words.scores(weights)
        found, forward, later = marginals(scores, count, transition)
        off = np.stack([np.bincount(words.kind, (gold - found)[:, j], minlength=kinds) for j in range(k)], axis=1)
        gradient = np.stack(
            [np.bincount(words.numbers, off[of_kind, j], minlength=len(weights)) for j in range(k)], axis=1
        ) - decay * n / 100 * weights
        speed += gradient**2
        weights += (rate * gradient / np.sqrt(speed)).astype(np.float32)
        # expected transitions, from the pairwise marginals of neighbouring words
        pair = forward[follows - 1][:, :, None] * np.exp(transition)[None] * later[follows][:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        slope = seen - pair.sum(axis=0)
        pace += slope**2
        transition = transition + 0.05 * slope / np.sqrt(pace)
    return labels, weights, transition


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string")) % 5 == 0


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE):
    """The model, from up to ``sample`` labelled texts of each language that are not held out."""
    ship_package(docs.sparkSession)
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & ~F.coalesce(held_out(key), F.lit(True)))
    known = known.select(F.col(key).alias("k"), F.col(label).cast("string").alias("label"), F.col(text).alias("t"))
    counts = known.groupBy("label").agg(F.count("*").alias("n")).collect()
    if not counts:
        return [], np.zeros((0, 0)), np.zeros((0, 0))
    order = F.pmod(F.xxhash64("k"), F.lit(1 << 30))
    # about twice the sample passes the hash's limit, then the first ones of each label are taken
    limits = F.create_map(*(x for r in counts for x in (F.lit(r.label), F.lit(min(1.0, 2 * sample / r.n)))))
    some = known.withColumn("o", order).where(F.col("o") < limits[F.col("label")] * (1 << 30))
    first = Window.partitionBy("label").orderBy("o", "k", F.xxhash64("t"))
    some = some.withColumn("r", F.row_number().over(first)).where(F.col("r") <= sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, pieces = [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = re.findall(r"[^\W\d_]+", value.lower())
                n = -(-len(words) // RUN)
                chosen = np.argsort(mix(np.arange(n, dtype=_U) + _U(len(value))), kind="stable")[:PIECES]
                for i in sorted(chosen.tolist()):
                    labels.append(name)
                    pieces.append(" ".join(words[i * RUN : (i + 1) * RUN]))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(pieces, pa.string())], ["l", "p"])

    rows = some.select("label", "t").mapInArrow(run, "l string, p string").collect()
    return fit(sorted((r.l, r.p) for r in rows))


def predict(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per text: key, label, score. One pass, no shuffle."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, weights, transition = shared.value
        for batch in batches:
            for part, block in blocks(batch, "__text"):
                names, scores = [UNKNOWN] * len(block), [0.0] * len(block)
                if labels:
                    words = FeatureWords(block)
                    found, _, _ = marginals(words.scores(weights), words.count, transition)
                    mass = np.stack(
                        [np.bincount(words.owner, found[:, j], minlength=len(block)) for j in range(len(labels))], axis=1
                    )
                    best = mass.argmax(axis=1)
                    for i, t in enumerate(block.texts):
                        if words.count[i] and _HAS_LETTER.search(t.decode()):
                            names[i] = labels[best[i]]
                            scores[i] = min(1.0, float(mass[i, best[i]] / words.count[i]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names), pa.array(scores)], [key, "lang_pred", "score"]
                )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", **options) -> DataFrame:
    """Train on what is not held out and predict every text: key, held_out, lang_pred, score."""
    found = predict(docs, train(docs, key, text, label, **options), key, text)
    return found.select(key, F.coalesce(held_out(key), F.lit(False)).alias("held_out"), "lang_pred", "score")
