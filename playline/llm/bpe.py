"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, all others by merges on a heap."""

from __future__ import annotations

import base64
import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from playline.llm.pretokens import Known, Pieces, spell
from playline.llm.spans import INVERSE, U64, char_values, id_and_text, mix, parts_of, span_hashes

#: Merged pre-tokens that a task remembers; beyond it, it begins anew.
REMEMBERED = 2_000_000
#: Keys of a bucket on average; larger makes the table smaller and slower to build.
PER_BUCKET = 4


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of the driver's machine, a line ``base64 rank`` each."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@dataclass
class PerfectHash:
    """Maps every key's 64-bit hash to a slot of its own, as many slots as keys.

    A bucket's keys get the first shift that sends all of them to free slots, large buckets first.
    A hash that is no key's finds another key's slot; ``hashes`` tells them apart.
    """

    shifts: np.ndarray
    hashes: np.ndarray

    @staticmethod
    def slot(hashes, shifts, size):
        return mix(hashes ^ (shifts.astype(U64) + U64(1)) * U64(INVERSE)) % U64(size)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        size = len(hashes)
        buckets = max(1, size // PER_BUCKET)
        of = (hashes % U64(buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        places = np.searchsorted(of[order], np.arange(buckets + 1))
        shifts, taken, table = np.zeros(buckets, np.int64), np.zeros(size, bool), hashes.copy()
        tried = np.arange(256)
        for bucket in np.argsort(places[:-1] - places[1:], kind="stable").tolist():
            keys = hashes[order[places[bucket] : places[bucket + 1]]]
            if not len(keys):
                break
            base = 0
            while True:
                slots = cls.slot(keys[None, :], (tried + base)[:, None], size).astype(np.int64)
                ranked = np.sort(slots, axis=1)
                free = ~taken[slots].any(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
                if free.any():
                    break
                base += len(tried)
            found = int(np.argmax(free))
            shifts[bucket] = base + found
            taken[slots[found]] = True
            table[slots[found]] = keys
        return cls(shifts, table)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 where it is no key's."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        shifts = self.shifts[(hashes % U64(len(self.shifts))).astype(np.int64)]
        slots = self.slot(hashes, shifts, len(self.hashes)).astype(np.int64)
        return np.where(self.hashes[slots] == hashes, slots, -1)


def merge(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merges the neighbours of lowest rank, the first of equals, until no pair has a rank.

    Parts are linked by the index of the next and the previous one; the heap holds pairs that may
    have gone since, which a changed end tells.
    """
    size = len(token)
    following, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = []
    for i in range(size - 1):
        rank = ranks.get(token[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    gone = [False] * size
    while heap:
        _, left, end = heapq.heappop(heap)
        if gone[left]:
            continue
        right = following[left]
        if right >= size or following[right] != end:
            continue
        following[left] = end
        gone[right] = True
        if end < size:
            before[end] = left
            rank = ranks.get(token[left : following[end]])
            if rank is not None:
                heapq.heappush(heap, (rank, left, following[end]))
        if before[left] >= 0:
            rank = ranks.get(token[before[left] : end])
            if rank is not None:
                heapq.heappush(heap, (rank, before[left], end))
    out, i = [], 0
    while i < size:
        out.append(ranks[token[i : following[i]]])
        i = following[i]
    return out


class Encoder:
    """The two tiers over one vocabulary, and the way back."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        keys = {}
        for token, rank in ranks.items():
            self.tokens[rank] = token
            try:
                keys[token.decode()] = rank
            except UnicodeDecodeError:
                pass  # part of a character, so never a whole pre-token
        points = np.frombuffer("".join(keys).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(k) for k in keys]).astype(np.int64)
        starts = np.concatenate([[0], ends])[:-1].astype(np.int64)
        hashes = span_hashes(points, starts, ends, char_values)
        self.table = PerfectHash.build(hashes)
        slot_ranks = np.zeros(len(keys), np.uint32)
        slot_ranks[self.table.find(hashes)] = list(keys.values())
        self.known = Known(REMEMBERED, slot_ranks)

    def places(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of a run's distinct pre-tokens are: in the table's slot for those in the
        vocabulary, else among the merged ones."""
        begin = self.table.find(pieces.hashes)
        length = np.ones(len(begin), np.int64)
        other = np.flatnonzero(begin < 0)
        begin[other], length[other] = self.known.find(
            pieces, other, lambda texts: [merge(t.encode(), self.ranks) for t in texts]
        )
        return begin, length

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = spell(texts, self.known, self.places)
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_encoders: dict[str, Encoder] = {}


def encoder(ranks_of) -> Encoder:
    """One encoder a worker process and vocabulary."""
    key, ranks = ranks_of.value
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(ranks)
    return _encoders[key]


def share(spark, ranks: dict[bytes, int]):
    """The vocabulary for the tasks; its size is fixed and does not follow the data."""
    listed = sorted(ranks.items(), key=lambda item: item[1])
    key = hashlib.sha256(repr(listed).encode()).hexdigest()
    return spark.sparkContext.broadcast((key, ranks))


def encode(
    docs: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, ids``: the token ids of every whole text; null and empty texts have none.

    ``ranks`` must have all single bytes. Special tokens' strings are ordinary text. A null key
    stays null, repeated rows each give a row, other columns are not read. No shuffle.
    """
    shared = share(docs.sparkSession, ranks)

    def run(batches):
        own = encoder(shared)
        for batch in parts_of(batches):
            texts = [(t or b"").decode() for t in batch.column(1).to_pylist()]
            found = own.encode(texts)
            places = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.uint32), *found]).astype(np.int32)
            ids = pa.ListArray.from_arrays(places, pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return id_and_text(docs, key, text).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``doc_id, utf8``: the bytes that ``doc_id, ids`` stand for; null ids give no bytes.

    An id that the vocabulary lacks fails the task.
    """
    shared = share(encoded.sparkSession, ranks)

    def run(batches):
        own = encoder(shared)
        for batch in parts_of(batches):
            found = [own.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], ["doc_id", "utf8"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, utf8 binary")


def digests(
    docs: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Both ways in one pass: the number of ids, and SHA-256 of the ids and of the decoded bytes.

    The ids' digest is of their decimal forms joined by one space. Edge cases as in ``encode``.
    """
    shared = share(docs.sparkSession, ranks)

    def run(batches):
        own = encoder(shared)
        decimal = [b"%d " % i for i in range(len(own.tokens))]
        for batch in parts_of(batches):
            texts = [(t or b"").decode() for t in batch.column(1).to_pylist()]
            out = []
            for ids in own.encode(texts):
                joined = b"".join(map(decimal.__getitem__, ids.tolist()))[:-1]
                out.append(
                    (
                        len(ids),
                        hashlib.sha256(joined).hexdigest(),
                        hashlib.sha256(own.decode(ids)).hexdigest(),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, k) for x, k in zip(zip(*out), kinds))], names
            )

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = [pa.int64(), pa.string(), pa.string()]
    return id_and_text(docs, key, text).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
