"""Token ids as raw binary shards with a minimal perfect hash index.

``shards/NNNNNN.ids`` holds the ids of one range of keys, in key order: the raw
little-endian ids, then the end of every record as 64-bit token positions, then a
footer.  ``index/NNNNNN.mph`` holds, for the keys whose hash falls into one bucket, a
minimal perfect hash and a slot per key: fingerprint, shard, first record, records.  A
key is found by one bucket file, a few bit tests and one slot; a foreign key fails the
fingerprint.  ``records`` is the catalogue both were made from.

Paths may be local or any address ``pyarrow.fs`` knows; executors must share them.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from threadtone.llm.common import files, published, stored, text_or_empty

END = 2
KEYS_PER_BUCKET = 100_000
#: Pieces of text whose ids a worker remembers: at most about 200 MB.
REMEMBERED = 800_000
_MAGIC = b"TTIDS001"
_FOOTER = "<QQQ8s"
_SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("first", "<u8"), ("count", "<u4")])

# The characters with the Unicode property White_Space.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# ASCII and Latin-1 letters; ASCII punctuation without the apostrophe.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGN = re.escape("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
#: Pieces that begin and end where a byte-level BPE's own splitting has a boundary.
_PIECE = re.compile(
    rf"\n(?=[^{_WHITE}])"
    rf"|[{_WHITE}]*(?:[{_LETTER}]+(?=[{_SIGN}{_WHITE}]|\Z)|[{_SIGN}]+(?=[{_LETTER}{_WHITE}]|\Z)|[^{_WHITE}]+)"
    rf"|[{_WHITE}]+"
)


#: Pieces that are one word to the tokenizer, which its model can take directly.
_WORD = re.compile(rf" ?(?:[{_LETTER}]+|[{_SIGN}]+)")


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for what follows U+00FF.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """Ids of texts as bytes; the library encodes each distinct piece of text once.

    The split into pieces holds for byte-level BPE with the usual word pattern, which
    ends a token before any run of white space that follows other characters, and
    between letters and ASCII punctuation other than the apostrophe.  With another
    tokenizer, and where a text spells an added token, whole texts go to the library.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # A task has one core.
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.type = f"<u{self.width}"
        self.known: dict[str, bytes] = {}
        self.letters = dict(enumerate(_byte_letters()))
        parts = json.loads(self.tokenizer.to_str())
        before = parts["pre_tokenizer"] or {}
        self.in_pieces = (
            parts["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and parts["model"].get("type") == "BPE"
        )
        self.added = [token["content"] for token in parts["added_tokens"]]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(x.ids, self.type).tobytes() for x in found]

    def _piece(self, piece: str) -> bytes:
        if _WORD.fullmatch(piece):
            found = self.model.tokenize(piece.encode().decode("latin-1").translate(self.letters))
            ids = [token.id for token in found]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def __call__(self, texts: list[str]) -> list[bytes]:
        whole = [not self.in_pieces or any(a in x for a in self.added) for x in texts]
        if any(whole):
            rest = iter(self([x for x, w in zip(texts, whole) if not w]) if not all(whole) else [])
            done = iter(self._library([x for x, w in zip(texts, whole) if w]))
            return [next(done if w else rest) for w in whole]
        pieces = [_PIECE.findall(x) for x in texts]
        new = set().union(*pieces).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = set().union(*pieces)
        for piece in new:
            self.known[piece] = self._piece(piece)
        ids = self.known.__getitem__
        return [b"".join(map(ids, x)) for x in pieces]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _texts(column: pa.Array, size: int = 1 << 20) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``size`` characters."""
    taken, total = [], 0
    for value in column:
        taken.append(value.as_py() or "")
        total += len(taken[-1])
        if total >= size:
            yield taken
            taken, total = [], 0
    if taken:
        yield taken


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = END,
    keys_per_bucket: int = KEYS_PER_BUCKET,
) -> None:
    """Encode every whole text, append ``end``, write shards in key order and the index.

    Null and empty texts are the end id alone.  Rows that repeat a key are records next
    to each other, ordered by text, and one index entry.  Rows with a null key come
    first; they are in the shards and the catalogue but in no index.  An empty table
    gives a catalogue without rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), str(context.taskAttemptId())
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        encode = encoder(tokenizer)
        last = np.array([end], encode.type).tobytes()
        ends, record = [], 0
        with published(f"{folder}/shards", f"{shard:06d}.ids", attempt) as out:
            out.write(_MAGIC)
            at = 0
            for batch in (b for bs in ([first], batches) for b in bs):
                counts = []
                for texts in _texts(batch.column(1)):
                    for ids in encode(texts):
                        out.write(ids + last)
                        counts.append(len(ids) // encode.width + 1)
                stops = at + np.cumsum(counts, dtype=np.uint64)
                ends.append(stops)
                at = int(stops[-1]) if len(stops) else at
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.full(n, shard, np.int32)),
                        pa.array(np.arange(record, record + n)),
                        pa.array(np.array(counts, np.int64)),
                    ],
                    ["key", "shard", "record", "n_tokens"],
                )
                record += n
            out.write(np.concatenate(ends).astype("<u8").tobytes())
            out.write(struct.pack(_FOOTER, record, at, encode.width, _MAGIC))

    # Catalogue rows are read several times; the shards must be written once.
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    schema = f"key {kind}, shard int, record long, n_tokens long"
    ordered.mapInArrow(run, schema).write.parquet(f"{folder}/records")
    records = spark.read.schema(schema).parquet(f"{folder}/records").filter("key is not null")
    buckets = max(1, -(-records.count() // keys_per_bucket))
    shards = spark.read.parquet(f"{folder}/records").agg(F.max("shard")).first()[0]
    layout = spark.createDataFrame([(buckets, (shards or 0) + 1, kind)], "buckets long, shards long, kind string")
    layout.coalesce(1).write.json(f"{folder}/layout")
    keyed = records.groupBy("key").agg(
        F.min("shard").alias("shard"), F.min("record").alias("first"), F.count("*").alias("count")
    )
    keyed = keyed.withColumn("bucket", _bucket(buckets)).withColumn("key", F.col("key").cast("string"))
    built = keyed.groupBy("bucket").applyInPandas(
        lambda pdf: _write_index(pdf, folder), "bucket long, n long, levels int"
    )
    built.write.parquet(f"{folder}/buckets")


def _bucket(buckets: int):
    return F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(buckets))


def _hashes(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every key."""
    digests = b"".join(xxhash.xxh3_128_digest(k.encode()) for k in keys)
    both = np.frombuffer(digests, "<u8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _spot(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where keys fall in the bit field of a level."""
    x = h1 + np.uint64(level) * (h2 | np.uint64(1))
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x % np.uint64(size)


@dataclass
class PerfectHash:
    """A minimal perfect hash: per level a bit field, bits set where one key falls alone.

    A key's number is the rank of its bit among all set bits of all levels.
    """

    sizes: list[int]
    words: np.ndarray
    ranks: np.ndarray

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        fields, sizes, level = [], [], 0
        while len(h1):
            size = -(-2 * len(h1) // 64) * 64
            spots = _spot(h1, h2, level, size)
            alone = np.bincount(spots.astype(np.int64), minlength=size) == 1
            fields.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = ~alone[spots]
            h1, h2, level = h1[rest], h2[rest], level + 1
            if level > 200:
                raise ValueError("two keys have the same 128-bit hash")
        words = np.concatenate([*fields, np.zeros(0, "<u8")])
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.uint64)])
        return cls(sizes, words, ranks.astype("<u4"))

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of every key; -1 where no level holds it."""
        found = np.full(len(h1), -1, np.int64)
        left, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            spots = _spot(h1[left], h2[left], level, size).astype(np.int64) + base
            word, bit = spots >> 6, (spots & 63).astype(np.uint64)
            held = self.words[word]
            here = (held >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1)))
            found[left[here]] = self.ranks[word[here]].astype(np.int64) + below[here]
            left, base = left[~here], base + size
        return found


def _write_index(pdf: pd.DataFrame, folder: str) -> pd.DataFrame:
    h1, h2 = _hashes(pdf["key"].tolist())
    perfect = PerfectHash.build(h1, h2)
    slots = np.zeros(len(pdf), _SLOT)
    at = perfect.find(h1, h2)
    slots["print"][at] = h2 >> np.uint64(32)
    for name in ("shard", "first", "count"):
        slots[name][at] = pdf[name].to_numpy()
    bucket = int(pdf["bucket"].iat[0])
    head = json.dumps({"sizes": perfect.sizes, "n": len(pdf)}).encode()
    with published(f"{folder}/index", f"{bucket:06d}.mph", str(TaskContext.get().taskAttemptId())) as out:
        out.write(struct.pack("<Q", len(head)) + head)
        for part in (perfect.words, perfect.ranks, slots):
            out.write(part.tobytes())
    return pd.DataFrame({"bucket": [bucket], "n": [len(pdf)], "levels": [len(perfect.sizes)]})


def _read_index(folder: str, bucket: int) -> tuple[PerfectHash, np.ndarray]:
    system, path = files(f"{folder}/index")
    with system.open_input_stream(f"{path}/{bucket:06d}.mph", compression=None) as data:
        raw = data.read()
    (size,) = struct.unpack_from("<Q", raw)
    head = json.loads(raw[8 : 8 + size])
    at, words = 8 + size, sum(head["sizes"]) // 64
    bits = np.frombuffer(raw, "<u8", words, at)
    ranks = np.frombuffer(raw, "<u4", words + 1, at + 8 * words)
    slots = np.frombuffer(raw, _SLOT, head["n"], at + 8 * words + 4 * (words + 1))
    return PerfectHash(head["sizes"], bits, ranks), slots


def find_keys(keys: DataFrame, folder: str) -> DataFrame:
    """``key, shard, first, count`` for the keys of the one column that the index holds."""
    spark = keys.sparkSession
    layout = spark.read.json(f"{folder}/layout").first()
    kind, buckets = layout["kind"], layout["buckets"]
    wanted = keys.toDF("key").filter("key is not null").select(F.col("key").cast(kind).alias("key"))
    wanted = wanted.distinct().withColumn("bucket", _bucket(buckets))
    wanted = wanted.withColumn("name", F.col("key").cast("string"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict[int, tuple[PerfectHash, np.ndarray]] = {}
        for batch in batches:
            for bucket, group in batch.groupby("bucket"):
                if bucket not in opened:
                    try:
                        opened = {bucket: _read_index(folder, bucket)}
                    except FileNotFoundError:  # no key of the table fell into it
                        continue
                perfect, slots = opened[bucket]
                h1, h2 = _hashes(group["name"].tolist())
                at = perfect.find(h1, h2)
                slot = slots[np.maximum(at, 0)]
                held = (at >= 0) & (slot["print"] == (h2 >> np.uint64(32)))
                yield pd.DataFrame(
                    {"key": group["key"].to_numpy()[held]}
                    | {n: slot[n][held].astype(np.int64) for n in ("shard", "first", "count")}
                )

    # A task for each bucket: adaptive execution would join tasks of so few bytes.
    dealt = wanted.repartitionByRange(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(run, f"key {kind}, shard int, first long, count long")


def _open_shard(folder: str, shard: int):
    system, path = files(f"{folder}/shards")
    data = system.open_input_file(f"{path}/{shard:06d}.ids")
    footer = struct.calcsize(_FOOTER)
    data.seek(data.size() - footer)
    records, _, width, magic = struct.unpack(_FOOTER, data.read(footer))
    if magic != _MAGIC:
        raise ValueError(f"no token shard: {path}/{shard:06d}.ids")
    data.seek(data.size() - footer - 8 * records)
    ends = np.concatenate([[0], np.frombuffer(data.read(8 * records), "<u8")]).astype(np.int64)
    return data, ends, width


def read_records(found: DataFrame, folder: str, digests: bool = False) -> DataFrame:
    """The records that ``found`` (``key, shard, first, count``) points to.

    ``key, shard, position, ids``: the position in tokens within the shard and the ids;
    with ``digests`` the columns ``n_tokens, ids_crc32`` stand in for the ids.
    """
    kind = found.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, data, ends, width = -1, None, None, 2
        for batch in batches:
            rows = []
            for key, shard, first, count in zip(batch["key"], batch["shard"], batch["first"], batch["count"]):
                if shard != number:
                    if data is not None:
                        data.close()
                    data, ends, width = _open_shard(folder, shard)
                    number = shard
                for record in range(first, first + count):
                    start, stop = ends[record], ends[record + 1]
                    data.seek(len(_MAGIC) + int(start) * width)
                    ids = np.frombuffer(data.read(int(stop - start) * width), f"<u{width}")
                    if digests:
                        rows.append((key, shard, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    else:
                        rows.append((key, shard, start, ids.astype(np.int64)))
            names = ["n_tokens", "ids_crc32"] if digests else ["ids"]
            yield pd.DataFrame(rows, columns=["key", "shard", "position", *names])

    what = "n_tokens long, ids_crc32 long" if digests else "ids array<long>"
    shards = found.sparkSession.read.json(f"{folder}/layout").first()["shards"]
    places = stored(found, "token-places")
    dealt = places.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "first")
    return dealt.mapInPandas(run, f"key {kind}, shard int, position long, {what}")


def unkeyed(spark: SparkSession, folder: str) -> DataFrame:
    """Where the records without a key are, in the form of ``find_keys``."""
    records = spark.read.parquet(f"{folder}/records").filter("key is null")
    return records.select("key", "shard", F.col("record").alias("first"), F.lit(1).cast("long").alias("count"))


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """``shard, base``: the ids in all shards before; one row per shard."""
    totals = spark.read.parquet(f"{folder}/records").groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def read_back(docs: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` of every record, read from the files.

    The keys of ``docs`` are looked up in the index and their ids read from the shards.
    """
    spark = docs.sparkSession
    found = find_keys(docs.select(key), folder).unionByName(unkeyed(spark, folder))
    # One row per shard: as many as the job that wrote them had tasks.
    placed = read_records(found, folder, digests=True).join(F.broadcast(shard_starts(spark, folder)), "shard")
    return placed.select(
        F.col("key").alias(key), (F.col("base") + F.col("position")).alias("start"), "n_tokens", "ids_crc32"
    )
