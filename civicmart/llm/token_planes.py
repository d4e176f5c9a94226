"""Token ids in a bit-plane format.

A file row is a chunk of whole documents: their ids, one after another, cut into blocks of fixed
size. A block is transposed into bit planes (plane k holds bit k of every id, packed eight to a
byte), and each plane is compressed with zstandard by itself: the high planes of most blocks are
nearly constant. The chunk keeps how many bits and ids it has and the lengths of its documents;
the chunk index, a table beside the files, keeps where each chunk begins in the whole sequence.

Rows are range-partitioned by id and sorted, so files follow one another in ascending order. The
texts move once, before they are encoded, and each chunk can be read by itself. Files are Parquet
rows, so Spark's commit protocol covers lost executors and any store Spark writes to will do.

Defined results. A null text counts as empty and gives the end id alone. Documents with a null
id come first; rows that share an id are ordered by the hash of their text and each keeps its own
place. A text of any length lies in one chunk. An empty table gives empty files; other columns
are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicmart.session import materialise

BLOCK = 1 << 16
# Ids after which a chunk is closed: its documents are some 1 MB of text.
CHUNK = 1 << 18
LEVEL = 3
# Bytes of parts and their ids that a worker keeps, with what Python needs around them. When full,
# it starts anew. Longer parts are rarely seen again and not kept.
KEPT, AROUND, LONGEST = 96_000_000, 170, 48

FILE_SCHEMA = (
    "part int, chunk int, n_docs int, n_ids bigint, bits int, block int, "
    "doc_ids array<bigint>, lengths array<bigint>, planes array<binary>"
)
READ_SCHEMA = "part int, chunk int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of whole texts from a tokenizer that never joins characters across white space.

    A text is cut into parts that the tokenizer encodes one by one in any case, and a part's ids
    are kept once they are known. Texts of printable ASCII, accented Latin-1 letters and white
    space are cut as the tokenizer's own pattern would; in others, words of other characters
    are a part as they stand. The tokenizer must mark word ends in its vocabulary: so the ids of
    many new parts, encoded in one call, can be told apart. A tokenizer whose file says that it
    normalises or cuts texts in another way encodes whole texts. ``check`` compares with encoding
    a text at once.
    """

    SPACES = str.maketrans("\n\r\t", "   ")
    # Lower case and composition are plain for these characters.
    PLAIN = re.compile(r"[ -~\n\r\tÀ-ÖØ-öø-ÿ]*")
    # The tokenizer's own pattern, over those characters.
    PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
    SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    DIGITS = "0123456789"
    # Cuts at both sides of a sign: white space for ``split``, and in no text of plain characters.
    EDGE = "\x1f"
    WORD_END = "</w>"
    # What a tokenizer file has to say for its texts to be cut so.
    CUT = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        self.by_parts = self._cuts_so(json.loads(self.tokenizer.to_str()))
        self.known: dict[str, bytes] = {}
        self.held = 0
        ends = [i for word, i in self.tokenizer.get_vocab().items() if word.endswith(self.WORD_END)]
        self.ends = np.array(sorted(ends), dtype="<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _cuts_so(self, file: dict) -> bool:
        steps = lambda part, name: (part or {}).get(name, [part])
        normal = steps(file["normalizer"], "normalizers")
        # Composition, white space to one space, lower case.
        spaces = [(s["pattern"].get("Regex"), s["content"]) for s in normal if s and s["type"] == "Replace"]
        if [s and s["type"] for s in normal] != ["NFC", "Replace", "Lowercase"] or spaces != [(r"\s+", " ")]:
            return False
        cuts = steps(file["pre_tokenizer"], "pretokenizers")
        if [c and c["type"] for c in cuts] != ["Split", "ByteLevel"] or cuts[1].get("add_prefix_space"):
            return False
        pattern = cuts[0]["pattern"].get("Regex") == self.CUT and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed"
        return pattern and file["model"]["type"] == "BPE" and file["model"].get("end_of_word_suffix") == self.WORD_END

    def parts(self, text: str) -> list[str]:
        if not self.PLAIN.fullmatch(text) or "<" in text and any(s in text for s in self.special):
            found = []
            for word in text.translate(self.SPACES).split(" "):
                if self.PLAIN.fullmatch(word) and word not in self.special and "<|" not in word:
                    found += self.PART.findall(word.lower())
                else:
                    found.append(word)
            return found
        text = text.lower()
        if "'" in text:
            return self.PART.findall(text)
        cut, edge = text, self.EDGE
        for sign in self.SIGNS:
            if sign in text:
                cut = cut.replace(sign, f"{edge}{sign}{edge}")
        # Signs side by side are one part.
        if edge + edge in cut:
            return self.PART.findall(text)
        for digit in self.DIGITS:
            if digit in text:
                cut = cut.replace(digit, f" {digit} ")
        return cut.split()

    def _direct(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, dtype="<u4").tobytes() for c in coded]

    def _learn(self, parts: list[str]) -> None:
        odd = [p for p in parts if not self.PLAIN.fullmatch(p) or "<|" in p]
        self.known.update(zip(odd, self._direct(odd)))
        parts = sorted(set(parts).difference(odd))
        for k in range(0, len(parts), 5_000):
            some = parts[k : k + 5_000]
            data = self._direct([" ".join(some)])[0]
            stops = np.flatnonzero(np.isin(np.frombuffer(data, dtype="<u4"), self.ends)) + 1
            if len(stops) == len(some) and 4 * stops[-1] == len(data):
                bounds = [0, *(4 * stops).tolist()]
                self.known.update((p, data[a:b]) for p, a, b in zip(some, bounds, bounds[1:]))
            else:
                self.known.update(zip(some, self._direct(some)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_parts:
            return [np.frombuffer(ids, dtype="<u4") for ids in self._direct(texts)]
        if self.held > KEPT:
            self.known, self.held = {}, 0
        # Most parts are known: one look-up each, and a second one only in texts with new parts.
        coded, partly, new = [], [], set()
        for k, text in enumerate(texts):
            parts = self.parts(text)
            ids = list(map(self.known.get, parts))
            try:
                coded.append(b"".join(ids))
            except TypeError:
                missing = [i for i, data in enumerate(ids) if data is None]
                coded.append(b"")
                partly.append((k, parts, ids, missing))
                new.update([parts[i] for i in missing])
        long = [part for part in new if len(part) > LONGEST]
        new.difference_update(long)
        if new:
            self._learn(list(new))
            self.held += sum(AROUND + len(part) + len(self.known[part]) for part in new)
        fresh = dict(zip(long, self._direct(long)))
        fresh.update((part, self.known[part]) for part in new)
        for k, parts, ids, missing in partly:
            for i in missing:
                ids[i] = fresh[parts[i]]
            coded[k] = b"".join(ids)
        return [np.frombuffer(data, dtype="<u4") for data in coded]

    def check(self, text: str) -> bool:
        whole = self.tokenizer.encode(text, add_special_tokens=False).ids
        return whole == self.encode([text])[0].tolist()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One for all tasks of a worker process, so that what it has learned is used again."""
    return Encoder(path)


def to_planes(ids: np.ndarray, bits: int, block: int = BLOCK) -> list[bytes]:
    """``bits`` compressed planes per block, lowest bit first."""
    packer, planes = zstandard.ZstdCompressor(level=LEVEL), []
    for k in range(0, len(ids), block):
        part = ids[k : k + block]
        for bit in range(bits):
            planes.append(packer.compress(np.packbits(((part >> bit) & 1).astype(np.uint8)).tobytes()))
    return planes


def from_planes(planes: list[bytes], n: int, bits: int, block: int = BLOCK) -> np.ndarray:
    unpacker, ids = zstandard.ZstdDecompressor(), np.zeros(n, dtype="<u4")
    for k in range(0, n, block):
        part = ids[k : k + block]
        for bit in range(bits):
            plane = np.frombuffer(unpacker.decompress(planes[k // block * bits + bit]), dtype=np.uint8)
            part |= np.unpackbits(plane, count=len(part)).astype("<u4") << np.uint32(bit)
    return ids


def _writer(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, chunk = _encoder(path), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        ids: list[np.ndarray] = []
        held, end = 0, np.array([end_id], dtype="<u4")

        def flush() -> pa.RecordBatch:
            nonlocal chunk, held
            whole = np.concatenate(ids)
            bits = max(1, int(whole.max()).bit_length())
            row = {
                "part": [part],
                "chunk": [chunk],
                "n_docs": [len(doc_ids)],
                "n_ids": [len(whole)],
                "bits": [bits],
                "block": [BLOCK],
                "doc_ids": [list(doc_ids)],
                "lengths": [[len(x) for x in ids]],
                "planes": [to_planes(whole, bits)],
            }
            doc_ids.clear()
            ids.clear()
            chunk, held = chunk + 1, 0
            kinds = [pa.int32()] * 3 + [pa.int64()] + [pa.int32()] * 2
            kinds += [pa.list_(pa.int64())] * 2 + [pa.list_(pa.binary())]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            names = batch["doc_id"].to_pylist()
            for k in range(0, len(names), 256):
                texts = [t or "" for t in batch["text"].slice(k, 256).to_pylist()]
                for name, coded in zip(names[k : k + 256], encoder.encode(texts)):
                    doc_ids.append(name)
                    ids.append(np.concatenate([coded, end]))
                    held += len(coded) + 1
                    if held >= CHUNK:
                        yield flush()
        if doc_ids:
            yield flush()

    return run


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int) -> tuple[DataFrame, DataFrame]:
    """The files and their chunk index (part, chunk, start, n_ids), both written.

    The position of a row in its scan is the last key, so that an id repeated without end still
    spreads over partitions.
    """
    rows = docs.select("doc_id", "text").withColumn("h", F.xxhash64("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange("doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row")
    files = materialise(rows.select("doc_id", "text").mapInArrow(_writer(tokenizer, end_id), FILE_SCHEMA), "planes")
    sizes = files.select("part", "chunk", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # One number per file.
    parts = parts.select("part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("base"))
    in_part = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    index = sizes.withColumn("inner", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0))).join(parts, "part")
    index = index.select("part", "chunk", (F.col("base") + F.col("inner")).alias("start"), "n_ids")
    return files, materialise(index, "chunk-index")


def read_documents(files: DataFrame) -> DataFrame:
    """A row per document: its chunk, where it begins there, its length and checksum. Each chunk
    is decoded by itself, without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"], row["bits"], row["block"])
                stops = np.cumsum(row["lengths"])
                starts = stops - row["lengths"]
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, stops)]
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["chunk"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(row["lengths"], pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "chunk", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    return files.mapInArrow(run, READ_SCHEMA)


def token_report(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """A row per document, from the files: (doc_id, start, n_tokens, ids_crc32)."""
    files, index = write_tokens(docs, tokenizer, end_id)
    return (
        read_documents(files)
        .join(index.select("part", "chunk", "start"), ["part", "chunk"])
        .select("doc_id", (F.col("start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
    )
