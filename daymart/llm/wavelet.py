"""Token shards as wavelet matrices: succinct bit planes with rank and select.

A shard file holds the token ids of consecutive documents. Plane ``b`` is the
b-th highest bit of every id, in the order that the planes above leave: ids
with a 0 go left, ids with a 1 go right, both in order. One file, opened once,
answers access (the id at a place), count (how often an id stands before a
place) and lookup (the place of its k-th occurrence) without being expanded:
each takes one rank or select for each plane.

File: 8 bytes magic, length of the JSON header, header, then the blocks it
lists, each compressed on its own: document ids, document ends, and planes.
Rank counts are rebuilt from the planes when a shard is opened.

Defined results: a null text is an empty document; a null document id sorts
first and is read back as null; rows of one id are ordered by their text;
equal rows are kept, each as a document, and share a shard, as its range cannot
be cut; a very long text is one document, held whole by its task; an empty table gives no file and no
rows. Other columns of the table are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymart.llm.files import file_system, finished_file, listed
from daymart.llm.tokens import ID_TYPE, encode_texts, encoder
from daymart.operators.scratch import scratch_path, settle

MAGIC = b"WAVEMTX1"
SUFFIX = ".wmx"
#: Text of one shard. A task holds a shard's ids and one reordering of them.
SHARD_TEXT_BYTES = 12 << 20
_WORD = 64
_ABSENT = -(1 << 63)


class BitPlane:
    """Bits with rank and select over words of 64."""

    def __init__(self, packed: np.ndarray, n: int):
        self.n = n
        padded = np.zeros(-(-n // _WORD) * 8 + 8, dtype=np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])
        self.zeros = n - int(self.before[-1])

    def get(self, i):
        i = np.asarray(i, dtype=np.int64)
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)

    def rank1(self, i):
        """Ones before place ``i``."""
        i = np.asarray(i, dtype=np.int64)
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask).astype(np.int64)

    def rank0(self, i):
        return np.asarray(i, dtype=np.int64) - self.rank1(i)

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) ``bit``."""
        counts = self.before if bit else np.arange(len(self.before)) * _WORD - self.before
        word = int(np.searchsorted(counts, k, side="right")) - 1
        left = k - int(counts[word])
        value = int(self.words[word]) if bit else ~int(self.words[word])
        for place in range(_WORD):
            if value >> place & 1:
                if left == 0:
                    return word * _WORD + place
                left -= 1
        raise IndexError(k)


def _narrow(bits: int) -> type:
    return np.uint16 if bits <= 16 else np.uint32


class WaveletMatrix:
    def __init__(self, planes: list[BitPlane], n: int):
        self.planes, self.n = planes, n

    @staticmethod
    def encode(ids: np.ndarray, bits: int) -> list[bytes]:
        planes, current = [], ids.astype(_narrow(bits))
        for b in range(bits - 1, -1, -1):
            ones = (current & current.dtype.type(1 << b)) != 0
            planes.append(np.packbits(ones, bitorder="little").tobytes())
            if b:
                current = np.concatenate([current[~ones], current[ones]])
        return planes

    def _check(self, i: int) -> None:
        if not 0 <= i < self.n:
            raise IndexError(i)

    def access(self, i: int) -> int:
        self._check(i)
        value = 0
        for plane in self.planes:
            bit = int(plane.get(i))
            value = value << 1 | bit
            i = plane.zeros + int(plane.rank1(i)) if bit else int(plane.rank0(i))
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the occurrences before ``i`` lie below the last plane."""
        start, end = 0, i
        for b, plane in zip(range(len(self.planes) - 1, -1, -1), self.planes):
            if token >> b & 1:
                start, end = plane.zeros + int(plane.rank1(start)), plane.zeros + int(plane.rank1(end))
            else:
                start, end = int(plane.rank0(start)), int(plane.rank0(end))
        return start, end

    def count(self, token: int, i: int | None = None) -> int:
        """Occurrences of ``token`` before place ``i`` (all of them by default)."""
        i = self.n if i is None else min(max(i, 0), self.n)
        if token < 0 or token >> len(self.planes):
            return 0
        start, end = self._range(token, i)
        return end - start

    def find(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        place = self._range(token, self.n)[0] + k
        for b, plane in zip(range(len(self.planes)), reversed(self.planes)):
            if token >> b & 1:
                place = plane.select(1, place - plane.zeros)
            else:
                place = plane.select(0, place)
        return place

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``, all planes walked at once."""
        at = np.arange(start, stop, dtype=np.int64)
        values = np.zeros(len(at), dtype=np.uint32)
        for plane in self.planes:
            bit = plane.get(at)
            ones = plane.rank1(at)
            values = (values << np.uint32(1)) | bit.astype(np.uint32)
            at = np.where(bit == 1, plane.zeros + ones, at - ones)
        return values

    def ids(self) -> np.ndarray:
        """All ids, rebuilt from the lowest plane up."""
        values = np.zeros(self.n, dtype=_narrow(len(self.planes)))
        for level, plane in zip(range(len(self.planes)), reversed(self.planes)):
            bits = np.unpackbits(plane.words.view(np.uint8), count=self.n, bitorder="little").astype(bool)
            above = np.empty_like(values)
            above[~bits] = values[: plane.zeros]
            above[bits] = values[plane.zeros :] | values.dtype.type(1 << level)
            values = above
        return values


def shard_bytes(doc_ids: list[int | None], encoded: list[bytes], vocabulary: int) -> bytes:
    """The file of one shard; ``encoded`` holds each document's ids as bytes."""
    ids = np.frombuffer(b"".join(encoded), dtype=ID_TYPE)
    bits = max(1, int(vocabulary - 1).bit_length())
    ends = np.cumsum([len(e) // 4 for e in encoded], dtype=np.int64)
    names = np.array([_ABSENT if d is None or pd.isna(d) else int(d) for d in doc_ids], dtype=np.int64)
    pack = zstandard.ZstdCompressor(level=1).compress
    blocks = [pack(names.tobytes()), pack(ends.tobytes()), *map(pack, WaveletMatrix.encode(ids, bits))]
    sizes = [len(b) for b in blocks]
    header = json.dumps({"docs": len(names), "tokens": len(ids), "bits": bits, "blocks": sizes}).encode()
    return b"".join([MAGIC, len(header).to_bytes(8, "little"), header, *blocks])


class Shard:
    """A shard file, opened from its bytes."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token shard")
        at = 16 + int.from_bytes(data[8:16], "little")
        self.header = json.loads(data[16:at])
        unpack = zstandard.ZstdDecompressor().decompress
        blocks = []
        for size in self.header["blocks"]:
            blocks.append(np.frombuffer(unpack(data[at : at + size]), dtype=np.uint8))
            at += size
        self.doc_ids = [None if d == _ABSENT else int(d) for d in blocks[0].view("<i8")]
        self.ends = blocks[1].view("<i8")
        n = self.header["tokens"]
        self.matrix = WaveletMatrix([BitPlane(b, n) for b in blocks[2:]], n)

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's k-th document."""
        return self.matrix.slice(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def open_shard(uri: str) -> Shard:
    system, path = file_system(uri)
    with system.open_input_stream(path, compression=None) as stream:
        return Shard(stream.read())


def write_shards(
    docs: DataFrame, folder: str, *, tokenizer: str, spaced: bool, end_id: int, shard_bytes_of_text: int = SHARD_TEXT_BYTES
) -> None:
    """Write ``docs`` (doc_id, text) as shards in ascending order of doc_id.

    Rows are dealt by ranges of (doc_id, text hash), so shards are about equal
    and no range waits for another.
    """
    columns = docs.select("doc_id", "text")
    total = columns.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-total // shard_bytes_of_text) + 1
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    dealt = columns.repartitionByRange(shards, *order[:2]).sortWithinPartitions(*order)
    numbered = dealt.select("doc_id", "text", F.spark_partition_id().alias("shard"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = encoder(tokenizer, spaced)
        end = np.array([end_id], dtype=ID_TYPE).tobytes()
        doc_ids: list = []
        encoded: list[bytes] = []
        shard = None
        for frame in frames:
            shard = int(frame["shard"].iloc[0]) if len(frame) else shard
            doc_ids += [None if pd.isna(d) else int(d) for d in frame["doc_id"]]
            encoded += [ids + end for ids in encode_texts(words, frame["text"].tolist())]
        if doc_ids:
            vocabulary = max(words.tokenizer.get_vocab_size(), end_id + 1)
            name = f"{folder}/shard-{shard:08d}{SUFFIX}"
            with finished_file(name) as stream:
                stream.write(shard_bytes(doc_ids, encoded, vocabulary))
            yield pd.DataFrame({"docs": [len(doc_ids)]})

    # The action writes the files; its rows are one count a shard.
    numbered.mapInPandas(write, "docs long").agg(F.sum("docs")).first()


DOCUMENTS = "shard long, place long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def read_shards(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Each document of the shards: where it is, its length and checksum, and its ids."""
    files = listed(spark, folder, f"*{SUFFIX}")
    # A row is a name here and a whole shard in its task: one task a shard.
    files = files.repartition(max(1, files.count()), F.col("path"))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for uri in frame["path"]:
                shard = open_shard(uri)
                ids = shard.matrix.ids().astype(ID_TYPE)
                data, ends = ids.tobytes(), shard.ends.tolist()
                starts = [0, *ends[:-1]]
                number = int(uri.rsplit("shard-", 1)[1].removesuffix(SUFFIX))
                for a in range(0, len(ends), 2000):
                    rows = range(a, min(a + 2000, len(ends)))
                    own = [data[4 * starts[k] : 4 * ends[k]] for k in rows]
                    out = {
                        "shard": number,
                        "place": list(rows),
                        "doc_id": pd.array([shard.doc_ids[k] for k in rows], dtype="Int64"),
                        "local_start": [starts[k] for k in rows],
                        "n_tokens": [len(i) // 4 for i in own],
                        "ids_crc32": list(map(zlib.crc32, own)),
                    }
                    yield pd.DataFrame(out | {"ids": own} if with_ids else out)

    return files.mapInPandas(read, f"{DOCUMENTS}, ids binary" if with_ids else DOCUMENTS)


def document_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, start over all shards, n_tokens, ids_crc32.

    The shards' own totals are one row a shard; their running sum is the only
    step that one task does.
    """
    rows = settle(read_shards(spark, folder, with_ids=False), "documents")
    totals = rows.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    started = rows.join(F.broadcast(bases), "shard")
    return started.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def token_documents(docs: DataFrame, *, tokenizer: str, spaced: bool, end_id: int) -> DataFrame:
    """Write the table as shards in the shared folder and read their index back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "shards")
    write_shards(docs, folder, tokenizer=tokenizer, spaced=spaced, end_id=end_id)
    if not any_shard(folder):
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return document_index(spark, folder)


def any_shard(folder: str) -> bool:
    from pyarrow import fs

    system, path = file_system(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return any(f.path.endswith(SUFFIX) for f in found)
