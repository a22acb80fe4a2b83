"""Token ids in binary files: every document compressed on its own with a dictionary that all of them share.

A file holds, in ascending order of ids: a magic, one zstandard frame per document (its ids as little-endian unsigned
integers of 2 or 4 bytes), an index (id, whether it is null, offset, number of ids) and a footer with the sizes and the
SHA-256 of the dictionary, which lies beside the files. A reader seeks to the frames that it wants.

Documents are range-partitioned by id, each task writes its range as files of bounded size, and the driver sees one row
per file, from which it works out where the ids of each file start. A repeated task writes files of new names, and only
those of the attempt that ended are listed, so lost executors leave nothing wrong behind.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import batch, shared_folder, slices, table

MAGIC = b"IDSZ0001"
_FOOTER = struct.Struct("<QQQB32s8s")  # index offset, documents, ids, bytes per id, dictionary, magic
_INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("n", "<u8")])
#: Where the pre-tokenizer always cuts: before a space or line end that stands between two others than white space.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: It cuts between a letter or digit and one of these marks too; an apostrophe may start a contraction.
_MARKS = np.isin(np.arange(256), list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'))
_ALNUM = np.array([chr(b).isascii() and chr(b).isalnum() for b in range(256)])
#: Fragments that a worker keeps with their ids, and the longest that is kept.
_KEPT, _LONGEST = 600_000, 64


#: White space other than the space and the line end.
_WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_UNCUT = ["  ", " \n", "\n ", "\n\n", *_WHITE]
_UNCUT_ASCII = [x for x in _UNCUT if x.isascii()]


def fragments(text: str) -> list[str]:
    """The text, cut before every single space and line end between two others than white space."""
    return _CUT.split(text)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where fragments start in the UTF-8 bytes of a text that is cut before all of its spaces and line ends."""
    after = _ALNUM[data]
    latin = np.flatnonzero(data[:-1] == 0xC3) + 1
    after[latin] = (data[latin] != 0x97) & (data[latin] != 0xB7)  # letters from \u00C0 to \u00FF, but for two signs
    starts = (data == 32) | (data == 10)
    starts[1:] |= _MARKS[data[1:]] & after[:-1]
    return np.flatnonzero(starts)


class Encoder:
    """Whole texts to ids through the tokenizers library, each distinct fragment only once.

    The pre-tokenizer cuts a text before a space or line end that stands between two other characters, and between a word and
    a mark, so what is between two such cuts gets the same ids wherever it stands.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        self.kept: dict[str, bytes] = {}
        lengths = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            lengths[i] = len(token)  # byte-level: a character for each byte
        self.lengths = lengths
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        checked = ["a b", "ab  c\n d", "é ñ", "a\nb", "a.\n\nb é\nñ\n", *(f"a{chr(m)}b é{chr(m)}{chr(m)} 1{chr(m)}" for m in np.flatnonzero(_MARKS))]
        for text, ids in zip(checked, self(checked), strict=True):
            if self.tokenizer.encode(text, add_special_tokens=False).ids != np.frombuffer(ids, self.kind).tolist():
                raise ValueError("this tokenizer doesn't cut at single spaces, line ends and marks")

    def _plain(self, text: str) -> bool:
        """Whether a text is cut before all of its spaces, line ends and marks after words."""
        uncut = _UNCUT_ASCII if text.isascii() else _UNCUT
        return not text.endswith((" ", "\n")) and not any(map(text.__contains__, uncut)) and not any(map(text.__contains__, self.added))

    def _ids(self, fragments: list[str]) -> Iterator[bytes]:
        """Ids of fragments, encoded many at a time and taken apart by their bytes.

        A word that is left out again comes before marks, and after white space at the end of a fragment.
        """
        for at in range(0, len(fragments), 512):
            some = fragments[at : at + 512]
            lead = np.array([0 if x[0] in " \n" and not before[-1].isspace() else 2 for before, x in zip(["a", *some], some, strict=False)])
            text = "".join([" a" + x if n else x for x, n in zip(some, lead.tolist(), strict=True)])
            encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)  # without offsets
            ids = np.array(encoded[0].ids, self.kind)
            ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])
            sizes = pc.binary_length(pa.array(some, pa.string())).to_numpy()
            stops = np.cumsum(sizes + lead)
            cuts = np.stack([stops - sizes, stops], 1)
            edges = np.searchsorted(ends, cuts)
            if ends[-1] != stops[-1] or (ends[edges] != cuts).any():
                raise ValueError("ids don't spell the text")
            raw = ids.tobytes()
            yield from (raw[a:b] for a, b in (edges * self.width).tolist())

    def _of(self, fragments: list[str]) -> list[bytes]:
        """Ids of different fragments, looked up or encoded."""
        found = list(map(self.kept.get, fragments))
        new = [k for k, ids in enumerate(found) if ids is None]
        room = _KEPT - len(self.kept)
        for n, (k, ids) in enumerate(zip(new, self._ids([fragments[k] for k in new]), strict=True)):
            found[k] = ids
            if n < room and len(fragments[k]) <= _LONGEST:
                self.kept[fragments[k]] = ids
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        # A line end before a text makes its first fragment one like the others; its id is left out again.
        whole, pieces, counts, heads = [], [], {}, {}
        for k, text in enumerate(texts):
            if not text or text[0].isspace():
                heads[k], *others = fragments(text)
            elif self._plain(text):
                whole.append(k)
                continue
            else:
                others = fragments("\n" + text)
            counts[k] = len(others)
            pieces += others
        values = [pa.array(pieces, pa.large_string())]
        if whole:
            joined = [b"\n" + texts[k].encode() for k in whole]
            starts = np.cumsum([0, *map(len, joined)])
            data = b"".join(joined)
            cuts = _cuts(np.frombuffer(data, np.uint8))
            counts |= zip(whole, np.diff(np.searchsorted(cuts, starts)).tolist(), strict=True)
            offsets = pa.py_buffer(np.append(cuts, len(data)).astype(np.int64))
            values.append(pa.LargeStringArray.from_buffers(len(cuts), offsets, pa.py_buffer(data)))
        coded = pa.concat_arrays(values).dictionary_encode()
        known = self._of(coded.dictionary.to_pylist())
        flat, lengths = np.frombuffer(b"".join(known), self.kind), np.fromiter(map(len, known), np.int64, len(known)) // self.width
        which = coded.indices.to_numpy()
        n, at = lengths[which], (np.cumsum(lengths) - lengths)[which]
        stops = np.cumsum(np.fromiter(counts.values(), np.int64, len(counts)))
        first = np.array([stop - counts[k] for k, stop in zip(counts, stops.tolist(), strict=True) if k not in heads], np.int64)
        n[first] -= 1
        at[first] += 1
        ends = np.concatenate([[0], np.cumsum(n)])
        take = np.repeat(at - ends[:-1], n)
        take += np.arange(len(take))
        raw, edges = flat[take].tobytes(), (ends[stops] * self.width).tolist()
        out = {k: raw[a:b] for k, a, b in zip(counts, [0, *edges], edges, strict=False)}
        for k, found in zip(heads, self.tokenizer.encode_batch_fast(list(heads.values()), add_special_tokens=False), strict=True):
            out[k] = np.array(found.ids, self.kind).tobytes() + out[k]
        return [out[k] for k in range(len(texts))]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def train_dictionary(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, size: int = 32 << 10, documents: int = 1000, pieces: int = 2000, piece_ids: int = 1024) -> bytes:
    """A dictionary from the ids of a bounded sample: the documents of the smallest hashes, cut into pieces, and of those the pieces of the smallest hashes.

    It steers compression only; every document is written, whatever the sample. Too little to train on gives no dictionary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, encode = pa.schema([("piece", pa.binary())]), encoder(tokenizer_path)
        for b in slices(batches, "__text"):
            for ids in encode(b.column("__text").cast(pa.string()).to_pylist()):
                step = piece_ids * encode.width
                yield batch(schema, [ids[i : i + step] for i in range(0, len(ids), step)])

    chosen = docs.where(F.length(text_col) > 0).select(F.col(text_col).cast("binary").alias("__text"), F.xxhash64(F.col(id_col)).alias("__h"))
    sample = chosen.orderBy("__h", "__text").limit(documents).select("__text").mapInArrow(run, "piece binary")
    samples = [bytes(r.piece) for r in sample.orderBy(F.xxhash64("piece"), "piece").limit(pieces).collect()]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class _Writer:
    """One file: frames as they come, then index and footer."""

    def __init__(self, folder: str, dictionary: bytes, width: int):
        self.system, root = fs.FileSystem.from_uri(folder)
        self.name = f"ids-{uuid.uuid4().hex}.bin"
        self.out = self.system.open_output_stream(f"{root}/{self.name}")
        self.out.write(MAGIC)
        self.at, self.index, self.width, self.hash = len(MAGIC), [], width, hashlib.sha256(dictionary).digest()

    def add(self, doc: int | None, frame: bytes, n: int) -> None:
        self.index.append((doc or 0, doc is None, self.at, n))
        self.out.write(frame)
        self.at += len(frame)

    def close(self) -> tuple[str, int, int]:
        index = np.array(self.index, _INDEX)
        n = int(index["n"].sum())
        self.out.write(index.tobytes())
        self.out.write(_FOOTER.pack(self.at, len(index), n, self.width, self.hash, MAGIC))
        self.out.close()
        return self.name, len(index), n


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = 128 << 20) -> list[dict]:
    """Write the ids of every whole text below ``folder`` (a URI that all executors reach) and list the files.

    Files are listed in ascending order of ids, nulls first, with ``start``, the number of ids before them. Null texts
    are empty; equal ids are ordered by text; an empty table gives no file. Runs one job, besides that for the sample.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer_path, id_col, text_col)
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/dictionary-{hashlib.sha256(dictionary).hexdigest()}.zdict") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)  # its size is a parameter
    end = b"" if end_id is None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("name", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])
        encode, seq, writer, part = encoder(tokenizer_path), 0, None, 0
        last = end if end_id is None else np.array([end_id], encode.kind).tobytes()
        known = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        compress = zstandard.ZstdCompressor(level=3, dict_data=known).compress
        for b in slices(batches, "__text", 4 << 20):
            part = b.column("__part")[0].as_py()
            for doc, ids in zip(b.column("__id").to_pylist(), encode(b.column("__text").cast(pa.string()).to_pylist()), strict=True):
                writer = writer or _Writer(folder, shared.value, encode.width)
                writer.add(doc, compress(ids + last), (len(ids) + len(last)) // encode.width)
                if writer.at >= file_bytes:
                    yield batch(schema, [part], [seq], *[[x] for x in writer.close()])
                    seq, writer = seq + 1, None
        if writer:
            yield batch(schema, [part], [seq], *[[x] for x in writer.close()])

    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__text"))
    ordered = rows.withColumn("__hash", F.xxhash64("__text")).repartitionByRange("__id", "__hash").sortWithinPartitions("__id", "__hash", "__text")
    files = (
        ordered.select(F.spark_partition_id().alias("__part"), "__id", "__text")
        .mapInArrow(run, "part int, seq int, name string, documents long, ids long")
        .collect()  # a row per file
    )
    listed, start = [], 0
    for f in sorted(files, key=lambda f: (f.part, f.seq)):
        listed.append({"path": f"{folder}/{f.name}", "documents": f.documents, "ids": f.ids, "start": start})
        start += f.ids
    return listed


class TokenFile:
    """Read access to one file, by position in its index; ids come as numpy arrays."""

    def __init__(self, path: str):
        self.system, root = fs.FileSystem.from_uri(path)
        self.file = self.system.open_input_file(root)
        self.file.seek(self.file.size() - _FOOTER.size)
        at, n, self.ids, width, digest, magic = _FOOTER.unpack(self.file.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        self.file.seek(at)
        self.index = np.frombuffer(self.file.read(n * _INDEX.itemsize), _INDEX)
        self.ends = np.append(self.index["offset"][1:], at).astype(np.int64)
        self.kind = np.dtype(f"<u{width}")
        with self.system.open_input_stream(f"{root.rpartition('/')[0]}/dictionary-{digest.hex()}.zdict") as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"the dictionary of {path} has changed")
        self.decompress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).decompress

    def __getitem__(self, k: int) -> np.ndarray:
        offset = int(self.index["offset"][k])
        self.file.seek(offset)
        frame = self.file.read(int(self.ends[k]) - offset)
        return np.frombuffer(self.decompress(frame), self.kind)

    def find(self, doc: int) -> list[np.ndarray]:
        """The documents of an id, found in the index without reading any other."""
        ids, nulls = self.index["id"], int(self.index["null"].sum())
        a, b = nulls + np.searchsorted(ids[nulls:], [doc, doc + 1])
        return [self[k] for k in range(a, b)]


def read_token_files(spark: SparkSession, files: Iterable[dict]) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32`` (of its ids as unsigned 32-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                file = TokenFile(path)
                n = file.index["n"].astype(np.int64)
                starts = start + np.cumsum(n) - n
                for at in range(0, len(n), 10_000):
                    some = slice(at, min(at + 10_000, len(n)))
                    sums, lengths = [], []
                    for k in range(some.start, some.stop):
                        ids = file[k]
                        lengths.append(len(ids))
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    if lengths != n[some].tolist():
                        raise ValueError(f"{path}: index and frames differ")
                    yield batch(schema, pa.array(file.index["id"][some], mask=file.index["null"][some] > 0), starts[some], lengths, sums)

    files = [(f["path"], f["start"]) for f in files]
    listed = spark.createDataFrame(files, "path string, start long")
    return listed.repartition(max(1, len(files))).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = write_token_files(table(spark, sf_dir, "documents"), shared_folder(spark), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_token_files(spark, files)
