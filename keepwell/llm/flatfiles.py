"""Token ids of all documents as flat binary files with 64-bit offsets.

``write`` puts the documents in ascending order of their key over range partitions;
each task encodes its documents and appends to three files of its own:

* ``<name>.ids``      unsigned little-endian ids, 16 bits if the vocabulary fits, else 32
* ``<name>.offsets``  unsigned 64-bit: number of ids before each document, and of all (local)
* ``<name>.keys``     signed 64-bit keys; the smallest number stands for a null key

``manifest.json`` lists the parts in order with their bases, the prefix sums of what the
parts before hold: one entry for each part, so nothing that grows with the documents comes to
the driver. Names hold a random part, and the manifest lists the files of the task
attempts that succeeded, so a task that is run again does no harm.

``read`` maps the files into memory (or reads ranges, where the folder is in a store) and
gives every document's place and ids' checksum.

Words repeat, so a block's distinct blank-separated words are encoded by the library once
and a task keeps about ``CACHE`` of them; this gives the same ids, as the vocabulary's
normalisation and splitting never look across white space. Special tokens' strings in a text
are ordinary text. A null or empty text has the end id only. Rows with equal keys
are ordered by the text's hash. An empty table gives a manifest without parts.
Columns other than key and text are not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType

from keepwell.llm.arrays import NOT_SPACE, Block, Words, blocks, ragged
from keepwell.session import ship_package

END_ID = 1
CACHE = 400_000
READ_DOCS = 4096
#: text whose distinct words are encoded together
WORD_BYTES = 2 << 20
NULL_KEY = -(1 << 63)
PART = "part int, name string, n_docs long, n_ids long"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True
    return out


# fixed values: how the vocabulary that the shortcut below is made for normalises and splits
WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


@lru_cache(maxsize=2)
def wordwise(path: str) -> bool:
    """Whether a file normalises and splits as the shortcut expects."""
    settings = json.loads(tokenizer(path).to_str())
    return settings["model"]["type"] == "BPE" and all(settings[k] == v for k, v in WORDWISE.items())


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with, for characters up to 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
    return {c: "".join(letter[x] for x in chr(c).encode()) for c in range(256)}


class Encoder:
    """Ids of blocks of texts; remembers words and their pieces.

    The library spends most of its time on normalising and splitting. Chunks of visible ASCII and of
    Latin-1 letters need no composition, and their case and splitting follow from a pattern on
    few characters, so their pieces go straight to the library's model; all others through the
    whole library. That holds for files that normalise and split as ``WORDWISE`` says; with any other, whole
    texts go through the library.
    """

    SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str, end_id: int = END_ID):
        self.library, self.end_id, self.wordwise = tokenizer(path), end_id, wordwise(path)
        self.model, self.letters = self.library.model, _byte_letters()
        # ids as the bytes of 32-bit numbers: joined without a loop over numbers
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        if len(self.known) > CACHE:
            self.known.clear()
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        known, pieces, rest = self.known, self.pieces, []
        for word in words:
            if word in known:
                continue
            text = word.decode()
            if not self.SIMPLE.fullmatch(text):
                rest.append(word)
                continue
            split = self.PIECES.findall(text.lower())
            for piece in split:
                if piece not in pieces:
                    tokens = self.model.tokenize(piece.translate(self.letters))
                    pieces[piece] = array("I", [t.id for t in tokens]).tobytes()
            known[word] = pieces[split[0]] if len(split) == 1 else b"".join([pieces[p] for p in split])
        for word, e in zip(rest, self.library.encode_batch([w.decode() for w in rest], add_special_tokens=False)):
            known[word] = array("I", e.ids).tobytes()

    def __call__(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with an end id after each, number of each text's ids)."""
        if not self.wordwise:
            whole = self.library.encode_batch([t.decode() for t in block.texts], add_special_tokens=False)
            lists = [[*e.ids, self.end_id] for e in whole]
            return np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists], np.int64)
        words = Words(block, NOT_SPACE)
        _, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        data = block.data.tobytes()
        distinct = [data[s:e] for s, e in zip(words.start[first].tolist(), words.end[first].tolist())]
        self._learn(distinct)
        found = [self.known[w] for w in distinct]
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        each = size[inverse]
        ids = flat[ragged((np.cumsum(size) - size)[inverse], each)]
        count = np.rint(np.bincount(words.owner, each, minlength=len(block))).astype(np.int64)
        return np.insert(ids, np.cumsum(count), self.end_id), count + 1


def write(
    docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID
) -> dict:
    """Write the files and the manifest into ``folder``, which all executors must reach; the manifest."""
    spark = docs.sparkSession
    ship_package(spark)
    path = path or default_path()
    if not isinstance(docs.schema[key].dataType, IntegralType):
        raise ValueError(f"the files hold keys as 64-bit integers; {key} is {docs.schema[key].dataType.simpleString()}")
    kind = "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        encode, part = Encoder(path, end_id), TaskContext.get().partitionId()
        name, docs_in, ids_in, files = f"part-{part:06d}-{uuid.uuid4().hex}", 0, 0, []
        for batch in batches:
            for rows, block in blocks(batch, "__text", WORD_BYTES):
                if not files:
                    files = [store.open_output_stream(f"{root}/{name}.{x}") for x in ("ids", "offsets", "keys")]
                    files[1].write(np.zeros(1, "<u8").tobytes())
                ids, count = encode(block)
                files[0].write(ids.astype(kind).tobytes())
                files[1].write((ids_in + np.cumsum(count)).astype("<u8").tobytes())
                keys = rows.column(0).cast(pa.int64()).fill_null(NULL_KEY)
                files[2].write(keys.to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                docs_in, ids_in = docs_in + len(block), ids_in + len(ids)
        for file in files:
            file.close()
        if files:
            columns = [pa.array([part], pa.int32()), pa.array([name]), pa.array([docs_in]), pa.array([ids_in])]
            yield pa.RecordBatch.from_arrays(columns, ["part", "name", "n_docs", "n_ids"])

    rows = docs.select(F.col(key), F.col(text).alias("__text"))
    order = [F.col(key), F.xxhash64("__text")]
    written = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, PART).collect()
    parts, before_docs, before_ids = [], 0, 0
    for r in sorted(written):
        parts.append({"name": r.name, "n_docs": r.n_docs, "n_ids": r.n_ids, "first_doc": before_docs, "first_id": before_ids})
        before_docs, before_ids = before_docs + r.n_docs, before_ids + r.n_ids
    manifest = {"ids": kind, "end_id": end_id, "n_docs": before_docs, "n_ids": before_ids, "parts": parts}
    with store.open_output_stream(f"{root}/manifest.json") as file:
        file.write(json.dumps(manifest).encode())
    return manifest


class Column:
    """Ranges of a file of numbers, memory-mapped where it is local."""

    def __init__(self, store, path: str, kind: str):
        self.kind = np.dtype(kind)
        local = isinstance(store, fs.LocalFileSystem)
        self.file = pa.memory_map(path) if local else store.open_input_file(path)

    def __getitem__(self, at: slice) -> np.ndarray:
        self.file.seek(at.start * self.kind.itemsize)
        return np.frombuffer(self.file.read_buffer((at.stop - at.start) * self.kind.itemsize), self.kind)


def documents(folder: str, part: dict, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, local offsets, ids) of consecutive documents of one part."""
    store, root = fs.FileSystem.from_uri(folder)
    types = {"ids": kind, "offsets": "<u8", "keys": "<i8"}
    ids, offsets, keys = (Column(store, f"{root}/{part['name']}.{x}", t) for x, t in types.items())
    start = 0
    while start < part["n_docs"]:
        place = offsets[start : min(start + READ_DOCS, part["n_docs"]) + 1].astype(np.int64)
        stop = start + max(1, int(np.searchsorted(place, place[0] + (1 << 21))) - 1)  # a few MB at a time
        stop = min(stop, start + len(place) - 1)
        place = place[: stop - start + 1]
        yield keys[start:stop], place, ids[int(place[0]) : int(place[-1])]
        start = stop


def read(spark: SparkSession, folder: str, manifest: dict | None = None, key: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, ids before it, number of ids and their checksum as 32-bit numbers."""
    ship_package(spark)
    if manifest is None:
        store, root = fs.FileSystem.from_uri(folder)
        with store.open_input_stream(f"{root}/manifest.json") as file:
            manifest = json.loads(file.read())
    kind = manifest["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                for keys, place, ids in documents(folder, part, kind):
                    wide, first = ids.astype("<u4"), place[0]
                    sums = [zlib.crc32(wide[a - first : b - first].tobytes()) for a, b in zip(place[:-1], place[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.int64(), mask=keys == NULL_KEY),
                            pa.array(part["first_id"] + place[:-1]),
                            pa.array(np.diff(place)),
                            pa.array(sums, pa.int64()),
                        ],
                        [key, "start", "n_tokens", "ids_crc32"],
                    )

    parts = spark.createDataFrame(
        [(p["name"], p["n_docs"], p["first_id"]) for p in manifest["parts"]], "name string, n_docs long, first_id long"
    )
    parts = parts.repartition(max(1, len(manifest["parts"])))
    return parts.mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids_crc32 long")
