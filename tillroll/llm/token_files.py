"""Token-ID files: flat unsigned ids, 64-bit document offsets, bases by prefix sums.

Documents are range-partitioned and sorted by id, those of one id by a digest of their text, those
without an id last. Each task encodes its documents and writes two
files: ``.bin`` holds ids on end (16 bits each if the vocabulary fits, else 32), ``.idx`` holds
n + 1 offsets and n document ids, all little-endian 64-bit. A task returns one manifest row, which also
says how many documents at the end of the file have no id; the prefix sum over the manifest, one
row per file, gives each file's base in the whole sequence.

A file's name is drawn anew in every attempt and only the manifest says which files count, so
retried or speculative tasks leave no wrong data. Files are written through ``pyarrow.fs``, which
reaches local and shared folders, HDFS, S3 and GCS; on a local path they are memory-mapped.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.pretokens import Encoder
from tillroll.llm.textarrays import runs
from tillroll.storage import scratch_path, stored_scratch

END_ID = 0
MANIFEST = "part int, name string, n_docs long, n_tokens long, n_nameless long"
# How a tokenizer file says that it splits as ``pretokens`` does.
KNOWN_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"

_encoders: dict[str, tuple] = {}


def splits_as_known(path: str) -> bool:
    """Does the file's tokenizer leave the text as it is and split it by the usual pattern, so that
    pre-tokens can be encoded apart? Only these parts of its JSON say so."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = spec.get("pre_tokenizer") or {}
    same = all(split.get(k) == v for k, v in KNOWN_SPLIT.items())
    return same and not spec.get("normalizer") and (spec.get("model") or {}).get("type") == "BPE"


def library_encoder(path: str) -> tuple[Encoder | None, Callable, list[str], int]:
    """Per worker: memory of pre-tokens (none if the file splits in another way), the library's own
    encoding, added tokens, vocabulary size."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def encode(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        memory = Encoder(encode, limit=1_000_000) if splits_as_known(path) else None
        _encoders[path] = memory, encode, added, size
    return _encoders[path]


def encode_texts(path: str, texts: list[str]) -> list[np.ndarray]:
    """Ids of whole texts, as the library's ``encode`` without special tokens gives them.

    Distinct pre-tokens are encoded once per worker. A text that spells an added token goes to
    the library whole, because added tokens are matched before the text is split, and so do
    all texts if the tokenizer normalises or splits in a way of its own.
    """
    memory, encode, added, _ = library_encoder(path)
    if memory is None:
        return [np.asarray(ids, np.int32) for ids in encode(texts)]
    slots, per_text = memory.slots(texts)
    lengths = np.cumsum(np.append(0, memory.lengths(slots)))
    cuts = lengths[np.cumsum(per_text)]
    found = np.split(memory.ids(slots), cuts[:-1]) if len(texts) else []
    for i, text in enumerate(texts):
        if any(a in text for a in added):
            found[i] = np.asarray(encode([text])[0], np.int32)
    return found


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder:
        folder = folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """Write the files and return the stored manifest with each file's ``base``.

    Null and empty texts hold the end id only. Equal ids stay next to each other, in the order of
    their texts' digests; documents without an id come after all others, in that order too. Other
    columns are not looked at. No rows give an empty manifest.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ids below 2**16 fit two bytes; the type is the same in every file.
        kind = "<u2" if library_encoder(tokenizer)[3] <= 1 << 16 else "<u4"
        part = TaskContext.get().partitionId()
        name = f"{part:06d}-{uuid.uuid4().hex}"
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        sizes, keys, nameless = [], [], 0
        with fs.open_output_stream(f"{root}/{name}.bin") as out:
            for batch in batches:
                for run in runs(batch):
                    texts = run.column("text").fill_null("").to_pylist()
                    for ids in encode_texts(tokenizer, texts):
                        out.write(np.append(ids, END_ID).astype(kind).tobytes())
                        sizes.append(len(ids) + 1)
                    nameless += run.column("doc_id").null_count
                    keys.append(run.column("doc_id").fill_null(0).to_numpy())
        if not sizes:
            return
        offsets = np.cumsum(np.append(0, sizes))
        with fs.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(offsets.astype("<i8").tobytes())
            out.write(np.concatenate(keys).astype("<i8").tobytes())
        yield pa.record_batch(
            [pa.array([part], pa.int32()), [name], [len(sizes)], [int(offsets[-1])], [nameless]],
            names=["part", "name", "n_docs", "n_tokens", "n_nameless"],
        )

    # The digest makes the order of equal ids the same in every run, and splits very many of them.
    order = [F.asc_nulls_last("doc_id"), "digest"]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("digest", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    manifest = stored_scratch(ordered.mapInArrow(write, MANIFEST), "manifest")
    # One row per file: the prefix sum is over as many rows as there were tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn(
        "base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    )


def open_ids(folder: str, name: str, n_docs: int, n_tokens: int) -> tuple[np.ndarray, ...]:
    """A file's ids, offsets and document ids; mapped into memory if the path is local."""
    fs, root = _open(folder)

    def flat(suffix: str) -> np.ndarray:
        path = f"{root}/{name}.{suffix}"
        if isinstance(fs, pafs.LocalFileSystem):
            return np.memmap(path, np.uint8, mode="r")
        with fs.open_input_stream(path) as stream:
            return np.frombuffer(stream.read(), np.uint8)

    ids, index = flat("bin"), flat("idx").view("<i8")
    ids = ids.view("<u2" if ids.nbytes == 2 * n_tokens else "<u4")
    return ids, index[: n_docs + 1], index[n_docs + 1 :]


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: where its ids start in the whole, how many, their checksum."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, keys = open_ids(folder, row["name"], row["n_docs"], row["n_tokens"])
                crcs = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                n = row["n_docs"]
                without = np.arange(n) >= n - row["n_nameless"]
                yield pa.record_batch(
                    [
                        pa.array(np.asarray(keys, np.int64), mask=without),
                        np.asarray(offsets[:-1], np.int64) + row["base"],
                        np.diff(offsets).astype(np.int64),
                        np.array(crcs, np.int64),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # Rows of the manifest are light, their files are not: a task for each, as when written.
    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, DOCUMENTS)


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write documents as token files in scratch and return what reading them back gives."""
    folder = scratch_path(spark, "token-files")
    return read_token_files(write_token_files(docs, tokenizer, folder), folder)
