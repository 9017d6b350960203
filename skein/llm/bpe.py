"""Byte-level BPE: a minimal perfect hash over the vocabulary, and a merge heap for its misses."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from skein.llm.common import CACHES, fresh, trimmed

#: Entries of a generation of a worker's memos. There are two generations of two memos, of
#: about 200 bytes an entry; results do not depend on them.
MEMO_ENTRIES = 200_000

#: A space before a visible character; the character stays with the next piece.
CUT = re.compile(r" (?=\S)").split
#: Patterns that never match across such a place. A text is cut there only for these; for others it is one piece.
SPACED = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class MinimalPerfectHash:
    """Hash-and-displace over a fixed key set: n keys, n slots, one probe.

    A first hash puts a key in a bucket, the bucket's displacement seeds a second hash that
    gives the slot. Buckets are placed from the largest to the smallest, each with the first
    displacement that sends all its keys to free slots; buckets of one key store the slot itself.
    """

    def __init__(self, keys: list[bytes], values: list[int], per_bucket: int = 3):
        n = len(keys)
        self.n = n
        self.buckets = max(1, n // per_bucket)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for k, key in enumerate(keys):
            groups[zlib.crc32(key) % self.buckets].append(k)
        free = bytearray(b"\x01") * n
        singles = []
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            members = groups[b]
            if len(members) <= 1:
                singles += [(b, k) for k in members]
                continue
            base = [self._word(keys[k]) for k in members]
            seed = 1
            while True:
                slots = [self._slot(word, seed) for word in base]
                if all(free[s] for s in slots) and len(set(slots)) == len(slots):
                    break
                seed += 1
            self.shift[b] = seed
            for s, k in zip(slots, members, strict=True):
                free[s], self.keys[s], self.values[s] = 0, keys[k], values[k]
        left = iter([s for s in range(n) if free[s]])
        for b, k in singles:
            s = next(left)
            self.shift[b] = -1 - s
            self.keys[s], self.values[s] = keys[k], values[k]

    @staticmethod
    def _word(key: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little")

    def _slot(self, word: int, seed: int) -> int:
        word = (word ^ (seed * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        word = (word * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
        return ((word >> 32) * self.n) >> 32

    def get(self, key: bytes) -> int:
        """The key's value, or -1 when it is not one of the keys."""
        if not self.n:
            return -1
        seed = self.shift[zlib.crc32(key) % self.buckets]
        slot = -1 - seed if seed < 0 else self._slot(self._word(key), seed)
        return self.values[slot] if self.keys[slot] == key else -1


class Memo:
    """A bounded mapping of two generations: a full young one replaces the old one."""

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def miss(self, key: str) -> bytes:
        value = self.old.get(key) or self.make(key)
        if len(self.young) >= MEMO_ENTRIES:
            self.old = self.young.copy()
            self.young.clear()  # the dict stays the same object for those who hold its get
        if len(key) <= 64:
            self.young[key] = value
        return value


class Codec:
    """Encodes and decodes by a rank table; every single byte must have a rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, whole: MinimalPerfectHash | None = None):
        self.find = regex.compile(pattern).findall
        self.cut = pattern in SPACED
        self.ranks = ranks
        self.whole = whole or MinimalPerfectHash(list(ranks), list(ranks.values()))
        self.pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.pieces[rank] = token
        self.tokens, self.spaced = Memo(self._ids), Memo(self._spaced)

    def merge(self, word: bytes) -> list[int]:
        """Lowest rank first, leftmost first among equals, by a heap over a linked list of byte spans."""
        n, ranks = len(word), self.ranks
        start = list(range(n + 1))  # start[i] is i while a span begins there, else -1
        after, before = list(range(1, n + 2)), list(range(-1, n))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(word[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            if start[i] < 0:
                continue
            mid = after[i]
            if mid >= n or after[mid] != end:
                continue  # one of the two spans has changed since this entry was made
            start[mid] = -1
            after[i] = end
            before[end] = i
            if end < n:
                rank = ranks.get(word[i : after[end]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, after[end]))
            left = before[i]
            if left >= 0:
                rank = ranks.get(word[left:end])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, end))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[word[i : after[i]]])
            i = after[i]
        return ids

    def _ids(self, token: str) -> bytes:
        word = token.encode("utf-8")
        whole = self.whole.get(word)
        ids = (whole,) if whole >= 0 else self.merge(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _all(self, text: str) -> bytes:
        seen, miss = self.tokens.young.get, self.tokens.miss
        return b"".join([seen(token) or miss(token) for token in self.find(text)])

    def _spaced(self, piece: str) -> bytes:
        return self._all(" " + piece)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers.

        For a pattern of ``SPACED`` the text is cut before every space that a visible character
        follows: it never matches across such a place, so the pieces' matches are the text's matches.
        """
        first, *rest = CUT(text) if self.cut else (text,)
        seen, miss = self.spaced.young.get, self.spaced.miss
        return b"".join([self._all(first), *[seen(p) or miss(p) for p in rest]])

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


_CODECS: dict[str, Codec] = CACHES.setdefault("bpe", {})


def codec(label: str, shared, pattern: str) -> Codec:
    """The worker's codec for a broadcast (ranks, perfect hash); made once in each Python worker."""
    if label not in _CODECS:
        _CODECS.clear()
        ranks, whole = shared.value
        _CODECS[label] = Codec(ranks, pattern, whole)
    return _CODECS[label]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``ids``, ``token_ids``.

    The driver reads ``ranks_path``, makes the perfect hash and broadcasts both; they are as
    large as the vocabulary, whatever the input. Null text counts as empty: no ids, digests of zero bytes. Decoding an
    encoded text gives its UTF-8 bytes back. Rows are independent: repeated rows give repeated
    results, null ids stay null, an empty table gives an empty one, other columns are ignored.
    There is no exchange; a batch's rows are all a worker holds.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<long>" * ids

    ranks = read_ranks(ranks_path)
    label = hashlib.md5(repr((ranks_path, pattern, len(ranks))).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast((ranks, MinimalPerfectHash(list(ranks), list(ranks.values()))))

    def run(batches):
        use = codec(label, shared, pattern)
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column(1).to_pylist():
                packed = use.encode(text or "")
                out[0].append(len(packed) // 4)
                out[1].append(hashlib.sha256(packed).hexdigest())
                out[2].append(hashlib.sha256(use.decode(packed)).hexdigest())
                if ids:
                    out[3].append(np.frombuffer(packed, dtype="<u4").astype(np.int64))
            columns = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(out[3], pa.list_(pa.int64())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(trimmed(run, "bpe"), schema)


def decode_ids(rows: DataFrame, ranks_path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with ``out_col`` (binary): the bytes of each row's ids; null ids give null, an empty list zero bytes.

    Underscores are added to ``out_col`` until no column has that name. An empty table gives an empty one.
    """
    name = fresh(out_col, rows.columns)
    schema = StructType([*rows.schema.fields, StructField(name, BinaryType())])

    shared = rows.sparkSession.sparkContext.broadcast({b: a for a, b in read_ranks(ranks_path).items()})

    def run(batches):
        pieces = shared.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            made = [None if x is None else b"".join(pieces[i] for i in x) for x in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, name])

    return rows.mapInArrow(run, schema)
