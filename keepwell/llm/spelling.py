"""Spelling variants: frequent words one letter apart, each led to its commonest form.

1. ``vocabulary``: runs of Latin letters are counted. A documented share of (text, run) pairs loses one letter,
   chosen by crc32, so that there are misspellings to find; a text's equal runs share that fate.
2. ``keyed``: two words one edit apart, the shorter of m letters, agree outside one of ``PIECES`` parts of these m
   letters. A word is filed once for each part and for m = its length and one less: under the letters before the
   part and, counted from the end, after it. An edit is found under the part that holds the first
   difference, and only there, so nothing is found twice. Files of more than ``FILE`` words are cut into
   blocks, and every two blocks of a file meet; no file is too large for a task, and none is left out.
3. ``Slices``: the bit-sliced position index of a batch of files. The words of a file fill columns of 64 bits; for every
   (column, position, letter) one number tells which of the 64 words have that letter there. A query reads a column's
   numbers letter by letter and keeps four sets of words side by side: without an error so far, with a replaced letter, with a
   letter more (position shifted back) and with a letter less (shifted ahead).
4. ``groups``: sums of the near words, the form, and the root by doubling of pointers. A form has at least
   ``RATIO`` times its word's occurrences, so the number of rounds follows from the largest count.

Nulls, empty texts and texts without letters have no words; a null id is read as empty text. Words are
of any length. Ties go to the word that comes first by code points. Repeated rows count twice. An empty table gives an
empty result. Columns other than key and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keepwell.llm.arrays import ragged
from keepwell.session import ship_package, written

#: letters of a word, occurrences of a word, and how much commoner a form is
LETTERS = 6
OCCURRENCES = 5
RATIO = 5
#: one (text, run) pair in so many loses a letter
MISPELT = 199
PIECES = 3
#: words of a file that meet in one block
FILE = 2048
#: rows of whole files that are indexed together, and (word, column) pairs that are searched together
BATCH = 8192
SEARCH = 1 << 16
#: distinct words a task holds before it hands on their counts
HELD = 200_000

_U = np.uint64


def runs(least: int = LETTERS) -> re.Pattern:
    """UTF-8 runs of at least so many of a-z and U+00C0 to U+00FF (bytes C3 80 to C3 BF), A-Z lower-cased before."""
    return re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least)


def misspelt(run: bytes, crc: int, share: int = MISPELT) -> bytes:
    """The run without the code point that ``crc`` names, if ``share`` divides it."""
    if crc % share:
        return run
    letters = run.decode()
    place = crc % len(letters)
    return (letters[:place] + letters[place + 1 :]).encode()


def vocabulary(
    docs: DataFrame, key: str, text: str, letters: int = LETTERS, occurrences: int = OCCURRENCES, share: int = MISPELT
) -> DataFrame:
    """word, n: all words of enough letters and occurrences."""
    ship_package(docs.sparkSession)

    def counted(total: Counter) -> pa.RecordBatch:
        words = [w.decode() for w in total]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = runs(letters), Counter()
        for batch in batches:
            ids, texts = batch.column(0).cast(pa.binary()), batch.column(1).cast(pa.binary())
            for row in range(batch.num_rows):
                body = texts[row].as_py()
                if not body:
                    continue
                start = zlib.crc32(b"%b:" % (ids[row].as_py() or b""))
                for word, n in Counter(found.findall(body.lower())).items():
                    crc = zlib.crc32(word, start)
                    if crc % share:
                        total[word] += n
                    else:
                        word = misspelt(word, crc, share)
                        if len(word.decode()) >= letters:
                            total[word] += n
                if len(total) >= HELD:
                    yield counted(total)
                    total = Counter()
        if total:
            yield counted(total)

    narrow = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    words = narrow.mapInArrow(run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def keyed(words: DataFrame, letters: int = LETTERS, pieces: int = PIECES) -> DataFrame:
    """m, piece, file, word, n: every word under each of its keys; ``file`` is a digest of the letters kept.

    Files whose digests collide are read as one, which finds the same words.
    """
    sized = words.withColumn("size", F.length("word"))
    both = F.filter(F.array("size", F.col("size") - 1), lambda m: m >= letters)
    rows = sized.withColumn("m", F.explode(both)).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))
    begin, end = F.expr(f"piece * m DIV {pieces}").cast("int"), F.expr(f"(piece + 1) * m DIV {pieces}").cast("int")
    before = F.substring("word", 1, begin)
    after = F.substring("word", F.col("size") - (F.col("m") - end) + 1, F.col("m") - end)
    return rows.select("m", "piece", F.xxhash64(before, after).alias("file"), "word", "n")


def blocked(filed: DataFrame, most: int = FILE) -> DataFrame:
    """The filed words with the pair of blocks (x, y) where they meet others and their ``own`` block."""
    file = ["m", "piece", "file"]
    large = filed.groupBy(*file).count().filter(F.col("count") > most)
    large = written(large.select(*file, F.ceil(F.col("count") / most).cast("int").alias("parts")))
    cut = filed.join(large, file, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("own", F.expr("CAST(pmod(xxhash64(word), parts) AS INT)"))
    met = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.select(*file, F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "word", "n")


class Slices:
    """The position index of a batch: ``file`` ascends over the words, which are Latin-1 bytes."""

    def __init__(self, words: list[bytes], file: np.ndarray):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        # a file starts a new column
        first = np.flatnonzero(np.r_[True, file[1:] != file[:-1]])
        count = np.diff(np.r_[first, len(file)])
        self.columns = -(-count // 64)  # of each file
        self.base = np.cumsum(self.columns) - self.columns
        self.first = first
        self.file = np.repeat(np.arange(len(first)), count)
        inside = np.arange(len(file)) - first[self.file]
        self.column = self.base[self.file] + inside // 64
        self.bit = _U(1) << (inside % 64).astype(_U)
        # one number for every (column, position, letter) that occurs
        self.reach = int(self.size.max(initial=0)) + 2
        word = np.repeat(np.arange(len(words)), self.size)
        place = np.arange(len(self.letters)) - self.start[word]
        code = self.code(self.column[word], place, self.letters)
        order = np.argsort(code, kind="stable")
        code = code[order]
        edge = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
        self.codes = code[edge]
        self.masks = np.bitwise_or.reduceat(self.bit[word][order], edge) if len(edge) else np.empty(0, _U)

    def code(self, column: np.ndarray, place: np.ndarray, letter: np.ndarray) -> np.ndarray:
        return (column * self.reach + place + 1) * 256 + letter

    def with_letter(self, column: np.ndarray, place: int, letter: np.ndarray) -> np.ndarray:
        """The words of each column that have the letter at the place; none at place -1."""
        code = self.code(column, np.int64(place), letter)
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.masks[at], _U(0))

    def only(self, which: np.ndarray) -> np.ndarray:
        """Each column's words among those numbered ``which``."""
        out = np.zeros(int(self.columns.sum()), _U)
        np.bitwise_or.at(out, self.column[which], self.bit[which])
        return out

    def near(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, near word) for all words one edit apart in one file, the shorter of ``m`` letters."""
        short = self.only(np.flatnonzero(self.size == m))
        long = self.only(np.flatnonzero(self.size == m + 1))
        reads = self.columns[self.file]
        word = np.repeat(np.arange(len(self.size)), reads)
        column = ragged(self.base[self.file], reads)
        order = np.argsort(-self.size[word], kind="stable")  # words that have ended are the last ones
        word, column = word[order], column[order]
        found = [
            self._searched(word[i : i + SEARCH], column[i : i + SEARCH], short, long, m) for i in range(0, len(word), SEARCH)
        ]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2

    def _searched(self, word, column, short, long, m) -> tuple[np.ndarray, np.ndarray]:
        size, start = self.size[word], self.start[word]
        exact = short[column] | long[column]
        replaced, more, less = (np.zeros(len(word), _U) for _ in range(3))
        alive = len(word)
        for i in range(int(size[0])):
            alive = int(np.searchsorted(-size[:alive], -i, "left"))  # those of more than i letters
            on = slice(0, alive)
            col, letter = column[on], self.letters[start[on] + i]
            here = self.with_letter(col, i, letter)
            before = exact[on].copy()
            replaced[on] = (replaced[on] & here) | (before & ~here)
            more[on] = (more[on] & self.with_letter(col, i - 1, letter)) | before
            less[on] = (less[on] | before) & self.with_letter(col, i + 1, letter)
            exact[on] = before & here
        near = np.where(size == m[word], (replaced & short[column]) | ((less | exact) & long[column]), _U(0))
        near |= np.where(size == m[word] + 1, more & short[column], _U(0))
        hit = np.flatnonzero(near)
        bits = np.unpackbits(near[hit].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(bits)
        row = hit[row]
        inside = (column[row] - self.base[self.file[word[row]]]) * 64 + bit
        return word[row], self.first[self.file[word[row]]] + inside

    def first_difference(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many letters two words share from their start."""
        out = np.zeros(len(a), np.int64)
        left = np.arange(len(a))
        i = 0
        while len(left):
            left = left[(self.size[a[left]] > i) & (self.size[b[left]] > i)]
            left = left[self.letters[self.start[a[left]] + i] == self.letters[self.start[b[left]] + i]]
            i += 1
            out[left] = i
        return out


NEAR = "word string, n_near long, best_n long, best string"


def _nearest(table: pa.Table, pieces: int) -> pa.RecordBatch:
    """For each word its near words under this key: their number and the commonest."""
    m, piece, own, x, y, n = (table.column(c).to_numpy() for c in ("m", "piece", "own", "x", "y", "n"))
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    index = Slices(words, table.column("run").to_numpy())
    a, b = index.near(m)
    # two blocks of one file: only words of different blocks; else all
    fits = (x[a] == y[a]) | (own[a] != own[b])
    # the part with the first difference owns the pair
    size = m[a].astype(np.int64)
    place = np.minimum(index.first_difference(a, b), size - 1)
    fits &= (piece[a] * size // pieces <= place) & (place < (piece[a] + 1) * size // pieces)
    a, b = a[fits], b[fits]
    order = np.lexsort((b, -n[b], a))  # words ascend inside a file
    a, b = a[order], b[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]][: len(a)])
    count = np.diff(np.r_[first, len(a)])
    text = table.column("word").combine_chunks()
    columns = [text.take(pa.array(a[first])), pa.array(count), pa.array(n[b[first]]), text.take(pa.array(b[first]))]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, letters: int = LETTERS, pieces: int = PIECES, most: int = FILE) -> DataFrame:
    """word, n_near, best_n, best for each word and key that has near words; sums belong to the caller."""
    ship_package(words.sparkSession)
    file = ["m", "piece", "file", "x", "y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, number, last = [], 0, 0, None
        for batch in batches:
            keys = np.rec.fromarrays([batch.column(batch.schema.get_field_index(c)).to_numpy() for c in file])
            new = np.r_[last is None or keys[0] != last, keys[1:] != keys[:-1]] if len(keys) else np.empty(0, bool)
            label = number + np.cumsum(new)
            if not len(keys):
                continue
            number, last = int(label[-1]), keys[-1]
            held.append(pa.Table.from_batches([batch]).append_column("run", pa.array(label)))
            rows += len(keys)
            if rows >= BATCH:
                table = pa.concat_tables(held)
                cut = int(np.searchsorted(table.column("run").to_numpy(), number))  # the last file may go on
                if cut:
                    yield from several(table.slice(0, cut))
                held, rows = [table.slice(cut)], table.num_rows - cut
        if rows:
            yield from several(pa.concat_tables(held))

    def several(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Files of one word have no near words."""
        label = table.column("run").to_numpy()
        same = label[1:] == label[:-1]
        table = table.filter(pa.array(np.r_[False, same] | np.r_[same, False]))
        if table.num_rows:
            yield _nearest(table, pieces)

    met = blocked(keyed(words, letters, pieces), most)
    dealt = met.repartition(*file).sortWithinPartitions(*file, "word")
    return dealt.mapInArrow(run, NEAR)


def rounds(largest: int, occurrences: int, ratio: int) -> int:
    """Doublings that follow any chain of forms to its end: each step multiplies the count by ``ratio``."""
    steps, n = 1, max(occurrences, 1) * ratio
    while n * ratio <= largest:
        steps, n = steps + 1, n * ratio
    return max(steps - 1, 0).bit_length()


def groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    letters: int = LETTERS,
    occurrences: int = OCCURRENCES,
    ratio: int = RATIO,
    share: int = MISPELT,
    pieces: int = PIECES,
    most: int = FILE,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary. ``ratio`` is 2 or more."""
    words = written(vocabulary(docs, key, text, letters, occurrences, share))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")
    near = near_words(words, letters, pieces, most).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    led = F.col("n") * ratio <= -F.col("best.less")
    judged = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(led, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(led, -F.col("best.less")).alias("form_n"),
        )
    )
    largest = judged.agg(F.max("n")).first()[0] or 0
    chains = judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(rounds(largest, occurrences, ratio)):
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        chains = written(chains.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))
    return judged.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
