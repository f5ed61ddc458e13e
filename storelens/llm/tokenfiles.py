"""Token-id files with a minimal perfect hash index for keyed access.

A folder written by ``write_files`` holds

* ``ids/shard-<n>-<attempt>.bin``: ids of consecutive documents as little-endian unsigned integers of
  ``id_width`` bytes, without any header; the shards in order hold the documents in ascending doc_id
  order. A shard that several attempts of a task have written counts in the attempt that the manifest names;
* ``manifest`` (Parquet): a row per document with its key, shard, attempt, place in it and number of ids;
* ``index`` (Parquet): a row per hash bucket with the displacements of its minimal perfect hash and
  the fingerprint, shard, offset and number of ids of each slot.

The key of a document is its doc_id and, where rows repeat an id, the number of the repeat.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir
from .common import whole_text

END_ID = 1
# Keys of an index bucket on average; a bucket is built in one go.
BUCKET_KEYS = 2_000
# Keys that share a displacement, on average.
GROUP_KEYS = 4
# Encodings of parts of words that each Python process keeps: with those of a portion more, a dictionary of this many
# doesn't double its table.
CACHE_PARTS = 600_000
_BATCH_BYTES = 3 << 20

MANIFEST = "doc_id long, repeat long, shard int, attempt long, pos long, offset long, n_tokens long"
# Spark's names of stores that Arrow has under another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss", "wasb": "abfss", "wasbs": "abfss"}


class WordEncoder:
    """Encodes texts by their words, through a ``tokenizers`` tokenizer that lowers the case and never
    joins a token across white space, nor across the border of letters and other marks.

    Words are split and told apart by Arrow; plain ones consist of letters and of marks behind them. The
    library encodes these parts, each once as long as it is kept, and what isn't plain as a whole. The
    ids of the texts are then gathered with numpy.
    """

    # Arrow takes these for white space, the tokenizer doesn't.
    ODD = re.compile("[\x1c-\x1f]")
    # Latin letters and then ASCII marks. Apostrophes are left out: the tokenizer cuts at some.
    PLAIN = "^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"

    def __init__(self, path: str) -> None:
        # The cores belong to Spark's tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        odd = [i for i, text in enumerate(texts) if self.ODD.search(text)]
        whole = self._library([texts[i] for i in odd])
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        split = pc.utf8_split_whitespace(pa.array(plain, pa.string()))
        coded = split.flatten().dictionary_encode()
        pieces, first, second = self._pieces(coded.dictionary)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        pool = np.frombuffer(b"".join(pieces), dtype=np.uint32)
        codes = coded.indices.to_numpy()
        used = np.stack([first[codes], second[codes]], axis=1).ravel()
        each = lengths[used]
        ends = np.cumsum(each)
        # Where the ids of each piece stand in the pool, less where they go.
        moves = (np.cumsum(lengths) - lengths)[used] - (ends - each)
        ids = pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(moves, each)]
        bounds = np.concatenate([[0], ends[1::2]])[split.offsets.to_numpy()]
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for i, data in zip(odd, whole):
            out[i] = np.frombuffer(data, dtype=np.uint32)
        return out

    def _pieces(self, words: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Encoded pieces, and for each word the first and second piece that it consists of."""
        cut = pc.extract_regex(words, self.PLAIN)
        letters = pc.utf8_lower(pc.struct_field(cut, 0)).dictionary_encode()
        marks = pc.struct_field(cut, 1).dictionary_encode()
        other = cut.is_null().to_numpy(zero_copy_only=False)
        known = [self._known(letters.dictionary.to_pylist()), self._known(marks.dictionary.to_pylist()),
                 list(self._library(words.filter(pa.array(other)).to_pylist()))]
        first = letters.indices.fill_null(0).to_numpy().astype(np.int64)
        second = marks.indices.fill_null(0).to_numpy() + len(known[0])
        first[other] = len(known[0]) + len(known[1]) + np.arange(other.sum())
        second[other] = sum(map(len, known))
        return [*known[0], *known[1], *known[2], b""], first, second

    def _known(self, names: list[str]) -> list[bytes]:
        parts = self.parts
        missing = [name for name in names if name not in parts]
        parts.update(zip(missing, self._library(missing)))
        out = [parts[name] for name in names]
        if len(parts) > CACHE_PARTS:
            self.parts = {}
        return out

    def _library(self, texts: list[str]) -> Iterator[bytes]:
        for encoding in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield array("I", encoding.ids).tobytes()


def id_width(tokenizer_path: str, end_id: int = END_ID) -> int:
    """Bytes of an id in the files: two where all ids fit, else four."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One per Python process, so that tasks share what is known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _portions(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of bounded size together."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py())
            size += len(texts[-1])
            if size > _BATCH_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def arrow_address(folder: str) -> str:
    """The address of a folder as Arrow knows it."""
    scheme, mark, rest = folder.partition("://")
    return f"{_SCHEMES.get(scheme, scheme)}{mark}{rest}"


def _shard_name(root: str, shard: int, attempt: int) -> str:
    return f"{root}/shard-{shard:06d}-{attempt}.bin"


def write_files(documents: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID) -> DataFrame:
    """Encode all documents into ``folder``; returns its manifest.

    Every task encodes a range of doc_ids and writes it to a shard of its own, under the name of its
    attempt. What a lost or repeated attempt has left is not named by the manifest, and nothing is renamed.
    Null texts count as empty and have only the end id. Null ids come first. Rows that repeat an id
    follow each other and are numbered from 0; equal ids are ordered by the hash of their text.
    An empty table gives no shards. Other columns are ignored.
    """
    kind = f"<u{id_width(tokenizer_path, end_id)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = context.partitionId()
        attempt = context.taskAttemptId()
        files, root = pafs.FileSystem.from_uri(arrow_address(f"{folder}/ids"))
        files.create_dir(root, recursive=True)
        encoder, out = _encoder(tokenizer_path), None
        position = offset = repeat = 0
        last: object = object()
        for ids, texts in _portions(batches):
            out = out or files.open_output_stream(_shard_name(root, shard, attempt))
            rows: list[tuple] = []
            for doc_id, values in zip(ids, encoder.encode(texts)):
                repeat = repeat + 1 if doc_id == last else 0
                last = doc_id
                values = np.append(values, end_id)
                out.write(values.astype(kind).tobytes())
                rows.append((doc_id, repeat, shard, attempt, position, offset, len(values)))
                position += 1
                offset += len(values)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _MANIFEST_TYPES)]
            yield pa.RecordBatch.from_arrays(columns, names=_MANIFEST_NAMES)
            # Arrow would keep what the words of the portion took, beside the encodings.
            pa.default_memory_pool().release_unused()
        if out:
            out.close()

    keyed = documents.select("doc_id", whole_text().alias("text"))
    content = F.xxhash64("text")
    ranged = keyed.repartitionByRange(F.col("doc_id").asc_nulls_first(), content).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), content)
    ranged.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/parts")
    spark = documents.sparkSession
    parts = spark.read.schema(MANIFEST).parquet(f"{folder}/parts")
    starts = _starts(parts)
    (parts.join(starts, "shard")
     .withColumn("start", F.col("_ids_before") + F.col("offset"))
     .withColumn("repeat", F.col("repeat") + F.when(F.col("doc_id").eqNullSafe(F.col("_first")),
                                                    F.col("_carried")).otherwise(0))
     .drop("_ids_before", "_first", "_carried")
     .write.parquet(f"{folder}/manifest"))
    return spark.read.parquet(f"{folder}/manifest")


_MANIFEST_NAMES = [part.split()[0] for part in MANIFEST.split(", ")]
_MANIFEST_TYPES = [{"long": pa.int64(), "int": pa.int32()}[part.split()[1]] for part in MANIFEST.split(", ")]


def _starts(parts: DataFrame) -> DataFrame:
    """Per shard: the ids before it, and for its first doc_id how often the shards before it end
    with the same. A row per shard."""
    null_first = F.struct(F.col("doc_id").isNotNull(), "doc_id")
    shards = parts.groupBy("shard").agg(
        F.sum("n_tokens").alias("_ids"), F.count("*").alias("_rows"),
        F.min(null_first)["doc_id"].alias("_first"), F.max(null_first)["doc_id"].alias("_last"),
        F.max(F.struct("pos", "repeat"))["repeat"].alias("_tail"))
    order = Window.orderBy("shard")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # How often an id stands at the end of a shard, and at the end of those before it if the shard
    # has this id only.
    single = F.col("_first").eqNullSafe(F.col("_last"))
    same = F.col("_first").eqNullSafe(F.lag("_last").over(order)) & (F.row_number().over(order) > 1)
    ids = F.coalesce(F.sum("_ids").over(before), F.lit(0))
    in_run = Window.partitionBy("_run").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return (
        shards.withColumn("_same", same)
        .withColumn("_run", F.sum(F.when(F.col("_same") & single, 0).otherwise(1)).over(order))
        .withColumn("_ids_before", ids)
        .withColumn("_ends", F.sum(F.col("_tail") + 1).over(in_run))
        .withColumn("_carried", F.when(F.col("_same"), F.lag("_ends").over(order)).otherwise(0))
        .select("shard", "_ids_before", "_first", "_carried")
    )


def key_hashes(doc_id: Column, repeat: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a key."""
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.xxhash64(name, repeat), F.xxhash64(repeat, name, F.lit("second"))


def _mixed(keys: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """64-bit finaliser over a key and a seed."""
    with np.errstate(over="ignore"):
        z = keys + (np.asarray(seed, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _groups(deal: np.ndarray, groups: int) -> np.ndarray:
    return (_mixed(deal, 0) % np.uint64(groups)).astype(np.int64)


def displacements(deal: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Minimal perfect hash by hash and displace, of keys given by two 64-bit hashes.

    Keys are dealt to groups of about ``GROUP_KEYS`` by the first hash; the groups, largest first,
    each take the first seed that sends the second hashes to free slots. Only seeds are stored.
    """
    count = len(keys)
    groups = max(1, -(-count // GROUP_KEYS))
    group = _groups(deal, groups)
    seeds = np.zeros(groups, dtype=np.uint32)
    taken = np.zeros(max(1, count), dtype=bool)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1))
    for g in sorted(range(groups), key=lambda g: (bounds[g] - bounds[g + 1], g)):
        own = keys[order[bounds[g]:bounds[g + 1]]]
        if not len(own):
            break
        first = 1
        while True:
            tried = np.arange(first, first + 256, dtype=np.uint64)
            slots = (_mixed(own[None, :], tried[:, None]) % np.uint64(count)).astype(np.int64)
            ordered = np.sort(slots, axis=1)
            good = ~taken[slots].any(axis=1) & ~(ordered[:, 1:] == ordered[:, :-1]).any(axis=1)
            if good.any():
                pick = int(np.argmax(good))
                seeds[g] = tried[pick]
                taken[slots[pick]] = True
                break
            first += 256
    return seeds


def slots_of(deal: np.ndarray, keys: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Slot of each key; keys that aren't in the index get some slot too."""
    return (_mixed(keys, seeds[_groups(deal, len(seeds))])).astype(np.uint64)


def _print_of(keys: np.ndarray) -> np.ndarray:
    return (_mixed(keys, 0xF1) >> np.uint64(32)).astype(np.uint32)


# What a slot holds besides its fingerprint.
_HELD = {"shard": "<i4", "attempt": "<i8", "offset": "<i8", "start": "<i8", "n_tokens": "<i8"}
INDEX = "bucket long, keys long, seeds binary, prints binary, " + ", ".join(f"{n} binary" for n in _HELD)


def bucket_count(rows: int) -> int:
    return max(1, -(-rows // BUCKET_KEYS))


def write_index(manifest: DataFrame, folder: str, buckets: int) -> DataFrame:
    """The index over ``manifest``, written to ``folder`` and returned.

    Keys are hashed and dealt to ``buckets`` buckets, which are built one by one.
    """
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        deal, keys = (frame[n].to_numpy(dtype=np.int64).view(np.uint64) for n in ("deal", "key"))
        seeds = displacements(deal, keys)
        slots = (slots_of(deal, keys, seeds) % np.uint64(len(keys))).astype(np.int64)
        at = np.argsort(slots)
        held = {name: [frame[name].to_numpy(dtype=kind)[at].tobytes()] for name, kind in _HELD.items()}
        return pd.DataFrame({
            "bucket": [frame["bucket"].iloc[0]], "keys": [len(keys)], "seeds": [seeds.astype("<u4").tobytes()],
            "prints": [_print_of(keys)[at].astype("<u4").tobytes()], **held})

    _keyed(manifest, buckets).groupBy("bucket").applyInPandas(build, INDEX).write.parquet(f"{folder}/index")
    return manifest.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _keyed(rows: DataFrame, buckets: int) -> DataFrame:
    deal, key = key_hashes(F.col("doc_id"), F.col("repeat"))
    return rows.withColumns({"deal": deal, "key": key}).withColumn("bucket", F.pmod("deal", F.lit(buckets)))


def look_up(keys: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, repeat`` of ``keys`` with their ``shard, attempt, offset, start, n_tokens``, from the index
    alone: a bucket, a seed, a slot and its fingerprint for each. Keys that it doesn't hold are left
    out (but for one in four billion, whose fingerprint agrees by chance)."""
    schema = "doc_id long, repeat long, shard int, attempt long, offset long, start long, n_tokens long"

    def find(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame({part.split()[0]: pd.Series(dtype="int64") for part in schema.split(", ")})
        row = held.iloc[0]
        deal, key = (asked[n].to_numpy(dtype=np.int64).view(np.uint64) for n in ("deal", "key"))
        spread = slots_of(deal, key, np.frombuffer(row["seeds"], "<u4"))
        slots = (spread % np.uint64(row["keys"])).astype(np.int64)
        known = np.frombuffer(row["prints"], "<u4")[slots] == _print_of(key)
        found = asked[known][["doc_id", "repeat"]].copy()
        for name, kind in _HELD.items():
            found[name] = np.frombuffer(row[name], kind)[slots[known]]
        return found

    asked = _keyed(keys.select("doc_id", "repeat"), buckets)
    return asked.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(find, schema)


def read_ids(found: DataFrame, folder: str, width: int) -> DataFrame:
    """Adds ``ids_crc32`` (over the ids as little-endian unsigned 32-bit integers) to rows of ``shard,
    attempt, offset, n_tokens``; every task reads the spans of the shards it got, in file order."""
    kinds = dict(found.dtypes)
    schema = ", ".join([f"`{n}` {kinds[n]}" for n in found.columns] + ["ids_crc32 long"])
    at = [found.columns.index(n) for n in ("shard", "attempt", "offset", "n_tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(arrow_address(f"{folder}/ids"))
        opened, source = None, None
        for batch in batches:
            sums = []
            for shard, attempt, offset, n in zip(*[batch.column(i).to_pylist() for i in at]):
                if shard != opened:
                    if source:
                        source.close()
                    source, opened = files.open_input_file(_shard_name(root, shard, attempt)), shard
                ids = np.frombuffer(source.read_at(width * n, width * offset), dtype=f"<u{width}")
                sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())],
                                             names=[*batch.schema.names, "ids_crc32"])
        if source:
            source.close()

    return found.repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset").mapInArrow(run, schema)


def token_digest(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, repeat, start, n_tokens, ids_crc32`` of every document, read back by key from files
    that are written to a new folder under the shared one."""
    spark: SparkSession = documents.sparkSession
    folder = work_dir(spark, "token-ids")
    if "://" not in folder:
        folder = f"file://{folder}"
    manifest = write_files(documents, tokenizer_path, folder)
    buckets = bucket_count(manifest.count())
    index = write_index(manifest, folder, buckets)
    found = look_up(manifest, index, buckets)
    return read_ids(found, folder, id_width(tokenizer_path)).select("doc_id", "repeat", "start", "n_tokens", "ids_crc32")
