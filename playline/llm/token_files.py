"""Token ids in files: ranked by frequency, four values to a control byte, data bytes apart.

A file is a Parquet table of blocks, written and read by Spark, so that it can lie in any store. A
block holds whole documents in ascending order of ``doc_id``: their ids, replaced by their rank
among all ids of the corpus by falling frequency, each in 1 to 4 little-endian bytes (``data``),
and two bits a value for that number of bytes less one, from the low bits up (``control``).
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline.llm.pretokens import Known, spell
from playline.llm.spans import batches_of, id_and_text
from playline.session import stage

#: Ids after which a block ends; a longer document has a block of its own.
BLOCK_IDS = 1 << 16
#: Encoded pre-tokens that a task remembers.
REMEMBERED = 2_000_000
#: Documents that a task takes at a time.
DOCUMENTS = 1000
#: For every control byte, the bytes of its four values.
WIDTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    quads[: len(values)] = extra
    control = (quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1).astype(np.uint8)
    used = np.arange(4) <= extra[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` values again, by lookup of every control byte's widths."""
    widths = WIDTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    out = np.zeros((count, 4), np.uint8)
    out[np.arange(4) < widths[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").ravel()


class Tokens:
    """The tokenizer in a worker. Where its own split is the byte-level pattern, each distinct
    pre-token of a run of texts goes to it once; otherwise whole texts do."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        parts = json.loads(definition)
        split = parts.get("pre_tokenizer") or {}
        self.by_parts = (
            parts.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
        )
        self.known = Known(REMEMBERED)

    def library(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [x.ids for x in found]

    def encode(self, texts: list[str], last: int) -> list[np.ndarray]:
        end = np.array([last], np.uint32)
        if not self.by_parts:
            return [np.append(np.array(x, np.uint32), end) for x in self.library(texts)]

        def find(pieces):
            return self.known.find(pieces, np.arange(len(pieces.hashes)), self.library)

        return [np.concatenate([*p, end]) for p in spell(texts, self.known, find)]


_tokens: dict[str, Tokens] = {}


def worker_tokens(shared) -> Tokens:
    key, definition = shared.value
    if key not in _tokens:
        _tokens.clear()
        _tokens[key] = Tokens(definition)
    return _tokens[key]


def write_tokens(
    docs: DataFrame,
    definition: str,
    path: str,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every whole text, with ``end_id`` behind it, into files below ``path``.

    ``definition`` is the tokenizer's JSON text. Special tokens' strings are ordinary text. Null and
    empty texts have the end id alone. Documents without a key come first, repeated keys lie side by
    side in the order of their ids. An empty table writes no block. Other columns are not read.

    The texts are encoded once and staged as ids; only ids are dealt by ranges of ``doc_id``. What
    reaches the driver has a row for each id of the vocabulary or each written partition. A task holds
    ``DOCUMENTS`` texts and their ids at a time.
    """
    with batches_of(docs.sparkSession, DOCUMENTS):
        write_blocks(id_and_text(docs, key, text), definition, path, end_id)


def write_blocks(texts: DataFrame, definition: str, path: str, end_id: int) -> None:
    """``write_tokens`` for ``doc_id`` and the text in UTF-8."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(
        (hashlib.sha256(definition.encode()).hexdigest(), definition)
    )

    def run(batches):
        own = worker_tokens(shared)
        for batch in batches:
            texts = [(t or b"").decode() for t in batch.column(1).to_pylist()]
            found = [x.astype("<u4") for x in own.encode(texts, end_id)]
            narrow = [x.astype("<u2") if x.max() < 1 << 16 else x for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x.itemsize for x in narrow], pa.int32()),
                    pa.array([x.tobytes() for x in narrow], pa.binary()),
                ],
                ["doc_id", "width", "ids"],
            )

    encoded = stage(
        texts.mapInArrow(run, "doc_id long, width int, ids binary"),
        "token-ids",
    )

    def values(batch):
        widths, blobs = batch.column("width").to_pylist(), batch.column("ids").to_pylist()
        return [np.frombuffer(b, f"<u{w}") for w, b in zip(widths, blobs)]

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            own = values(batch)
            if own:
                seen = np.bincount(np.concatenate(own).astype(np.int64), minlength=len(total))
                seen[: len(total)] += total
                total = seen
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    ranked = (
        encoded.mapInArrow(count, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "id")
        .collect()
    )
    order = np.array([r.id for r in ranked], np.uint32)
    rank_of = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank_of)

    def block(part, before, ids, found):
        whole = np.concatenate(found)
        control, data = pack(ranks.value[whole])
        return {
            "part": part,
            "before": before,
            "doc_ids": ids,
            "lengths": [len(x) for x in found],
            "control": control,
            "data": data,
        }

    def write(batches):
        part, before, ids, found, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), values(batch)):
                ids.append(doc_id)
                found.append(own)
                size += len(own)
                if size >= BLOCK_IDS:
                    yield pa.RecordBatch.from_pylist([block(part, before, ids, found)], BLOCK)
                    before, ids, found, size = before + size, [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([block(part, before, ids, found)], BLOCK)

    (
        encoded.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(write, BLOCK_COLUMNS)
        .write.option("compression", "zstd")
        .parquet(f"{path}/blocks")
    )
    listed = [(i, int(x)) for i, x in enumerate(order)]
    spark.createDataFrame(listed, "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")


BLOCK_COLUMNS = (
    "part int, before long, doc_ids array<bigint>, lengths array<int>, control binary, data binary"
)
BLOCK = pa.schema(
    [
        ("part", pa.int32()),
        ("before", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int32())),
        ("control", pa.binary()),
        ("data", pa.binary()),
    ]
)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids``: the ids of each document as little-endian unsigned 32-bit integers,
    and how many ids all documents before it have."""
    blocks = spark.read.schema(BLOCK_COLUMNS).parquet(f"{path}/blocks")
    ranked = spark.read.schema("rank int, id long").parquet(f"{path}/ranks").collect()
    order = np.zeros(len(ranked), np.uint32)
    for r in ranked:
        order[r.rank] = r.id
    # One row for each task that wrote; later reads of blocks need no order.
    sizes = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    totals = blocks.groupBy("part").agg(F.sum(sizes).alias("n")).orderBy("part").collect()
    offsets, before = {}, 0
    for r in totals:
        offsets[r.part] = before
        before += r.n
    shared = spark.sparkContext.broadcast((order, offsets))

    def run(batches):
        order, offsets = shared.value
        for batch in batches:
            for b in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                lengths = np.array(b["lengths"], np.int64)
                ids = order[unpack(b["control"], b["data"], int(lengths.sum()))].astype("<u4")
                stops = np.cumsum(lengths)
                starts = stops - lengths
                own = [ids[i:j].tobytes() for i, j in zip(starts.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(b["doc_ids"], pa.int64()),
                        pa.array(starts + b["before"] + offsets[b["part"]]),
                        pa.array(own, pa.binary()),
                    ],
                    ["doc_id", "start", "ids"],
                )

    return blocks.mapInArrow(run, "doc_id long, start long, ids binary")
