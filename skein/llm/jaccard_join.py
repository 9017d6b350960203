"""N-gram Jaccard join by universe partition and pigeonhole.

Every document is a set of hashed word n-grams. For a size band the hash universe is cut into
``m`` segments; a set's part in a segment is its segment subset. Two sets of sizes s <= r link
only if they differ in at most H = floor((r + s) / 7) members (for a similarity of 3/4), so
whichever segments the larger set's probes choose, if their units exceed H, then in one of
them the smaller set differs by less than its units: by nothing (one unit: equal subsets), or
by at most one member (two units: a one-deletion neighbourhood meets the other's subset).

N-grams are compared by 64-bit hashes, so "exact" holds up to collisions: the odds that any two
different n-grams of a pair of texts of n n-grams in all share a hash are below n * n / 2**65
(for two texts of 20,000 words, 2e-11).
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import discard, distinct, fresh, mix64, stored, trim, trimmed
from skein.llm.components import components

WORDS = 5
#: Similarity: 4 * intersection >= 3 * union. The bound on differences below is derived from it.
NUM, DEN = 3, 4
#: Bytes of text that a Python worker handles at once (a longer text is alone).
SLICE_BYTES = 6 << 20
#: Documents of the sample that tells common n-grams, and the documents that make one common.
#: It steers costs only: which segments a set probes. Results do not depend on it.
HOT_SAMPLE, HOT_DOCS = 1024, 6
#: Rounds that resolve buckets locally before the round that tests every pair still open.
ROUNDS = 3
#: Most members (n-grams in all) of a bucket that one task holds in a round; larger ones are cut into chunks, dealt anew in every round.
CHUNK_MEMBERS, CHUNK_DOCS = 4_000_000, 1024
#: Members on either side of a block of pairs in the last round.
BLOCK_DOCS = 512
#: Bytes of the input's files that one partition of signatures stands for, and the most partitions.
PART_BYTES, MOST_PARTS = 16 << 20, 50_000
#: Distinct sets that a map task remembers to collapse copies; then it starts afresh (a copy is sent once more).
SEEN = 200_000
#: Candidate documents up to which their ids, labels and places (24 bytes each) are broadcast;
#: beyond, they are joined by shuffles.
BROADCAST_IDS = 500_000
#: Bytes of sketches (one bit or two per n-gram of a candidate) up to which they are broadcast to thin the
#: buckets before any set is sent; beyond, buckets are resolved as they are.
BROADCAST_SKETCHES = 48 << 20

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


# -- sets --------------------------------------------------------------------------


def _slices(texts: pa.Array):
    """(start, length) ranges of about ``SLICE_BYTES``."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for k, n in enumerate(size.tolist()):
        if k > start and total + n > SLICE_BYTES:
            yield start, k - start
            start, total = k, 0
        total += n
    if start < len(size):
        yield start, len(size) - start


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """A sorted array of distinct 64-bit n-gram hashes for each text.

    A-Z is lower-cased and words are runs without ASCII white space. A text of fewer than
    ``words`` words is one n-gram of them all; one without words, or null, is empty.
    """
    if pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.string())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    full = pc.greater(pc.binary_length(flat), 0)
    flat, owner = flat.filter(full), owner[full.to_numpy(zero_copy_only=False)]
    coded = flat.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    unit = np.fromiter((digest(w) for w in coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
    unit = unit[coded.indices.to_numpy()] if len(coded) else unit
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    n = len(unit) - words + 1
    every = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(words):
        every += unit[j : j + n] * _MULT[j % 5] * np.uint64(2 * (j // 5) + 1) if n > 0 else 0
    every = mix64(every + np.uint64(words))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(distinct(every[a : b - words + 1]))
        elif b > a:
            total = np.uint64(0)
            with np.errstate(over="ignore"):
                for j in range(b - a):
                    total = total + unit[a + j] * _MULT[j % 5] * np.uint64(2 * (j // 5) + 1)
                out.append(mix64(np.array([total + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


# -- allocation --------------------------------------------------------------------

#: Signatures that one probe with a single member is worth; chance of a set without enough units.
PRICE, RISK = 4.0, 1e-12


def units_needed(n: int) -> int:
    """One more than the members in which a set of ``n`` can differ from a linked set of at most its size."""
    return 2 * n * (DEN - NUM) // (DEN + NUM) + 1


def band_of(n: int) -> int:
    """Band b holds sizes 2**b to 2**(b+1) - 1."""
    return n.bit_length() - 1


@cache
def allocate(band: int) -> tuple[int, bool]:
    """(segments, deletions) of a band by least cost; 0 segments: every n-gram is a segment.

    The cost of a set is the signatures it sends plus a price for each unit that only a subset
    of one member can give (these are the common ones). An allocation is allowed when the
    chance that all members of a set fall in too few segments for the units needed, bounded by
    C(m, t) * (t / m) ** n, is under ``RISK`` at sizes across the band.
    """
    lo, hi = 1 << band, (2 << band) - 1
    sizes = (lo, (lo + hi) // 2, hi)
    best = (sum(n + PRICE * units_needed(n) for n in sizes), 0, False)
    for x in (0.25, 0.5, 0.75, 1.0, 1.25, 1.5, 2.0, 2.5, 3.0, 4.0):
        m = math.ceil(hi / x)
        for deletions in (False, True):
            cost, safe = 0.0, True
            for n in sizes:
                load, need = n / m, units_needed(n)
                none, one = math.exp(-load), load * math.exp(-load)
                some, more = m * (1 - none), m * (1 - none - one)
                few = max(need - 1 - deletions, 0)  # segments that cannot hold the units (a pair in one gives one more)
                if few:
                    safe &= few < m and math.lgamma(m + 1) - math.lgamma(few + 1) - math.lgamma(m - few + 1) + n * math.log(few / m) < math.log(RISK)
                units = 2 * more if deletions else more
                cost += some + (n - m * one if deletions else 0) + PRICE * max(0.0, need - units)
            if safe and cost < best[0]:
                best = (cost, m, deletions)
    return best[1], best[2]


_SHORT = "n-gram join: a set's segments hold too few units"


class Short(Exception):
    """A set whose segments hold too few units; another seed cuts the universe elsewhere."""

    def __init__(self):
        super().__init__(_SHORT)


def signatures(members: np.ndarray, band: int, probe: bool, hot: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(probe keys, other keys) of a set in a band's universe."""
    m, deletions = allocate(band)
    n = len(members)
    salt = np.uint64(((band + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    place = mix64(members + salt) if seed else members  # seed 0 uses the hash itself, which is sorted
    if seed:
        order = np.argsort(place)
        place, members = place[order], members[order]
    word = mix64(members ^ salt)
    if not m:
        starts, segment = np.arange(n), members
    else:
        segment = ((place >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        starts = np.concatenate([[0], np.flatnonzero(np.diff(segment)) + 1])
        segment = segment[starts]
    sums = np.add.reduceat(word, starts)
    keys = mix64(sums + salt * (segment + np.uint64(1)))
    if deletions:
        sizes = np.diff(np.append(starts, n))
        of = np.repeat(np.arange(len(starts)), sizes)
        part = sizes[of] >= 2
        less = mix64(sums[of][part] - word[part] + salt * (segment[of][part] + np.uint64(1)))
        of = of[part]
    if not probe:
        return keys[:0], np.concatenate([keys, less]) if deletions else keys
    need = units_needed(n)
    sizes = np.diff(np.append(starts, n))
    rare = sizes
    if len(hot):
        at = np.minimum(np.searchsorted(hot, members), len(hot) - 1)
        rare = np.add.reduceat((hot[at] != members).astype(np.int64), starts)
    order = np.lexsort((-sizes, -rare))
    chosen = np.zeros(len(keys), dtype=np.int8)
    chosen[order[:need]] = 1
    if deletions:
        # two units where a subset has rare company, one unit on what is then still needed
        left = need
        chosen[:] = 0
        good = [k for k in order.tolist() if sizes[k] >= 2]
        single = [k for k in order.tolist() if sizes[k] < 2 and rare[k]]
        for k in good:
            if left > 0 and rare[k]:
                chosen[k], left = 1, left - 1
        for k in good:
            if left > 0:
                left, chosen[k] = left - (2 - chosen[k]), 2
        for k in single + [k for k in order.tolist() if sizes[k] < 2 and not rare[k]]:
            if left > 0:
                chosen[k], left = 1, left - 1
        if left > 0:
            raise Short
        twice = chosen[of] == 2
        return np.concatenate([keys[chosen > 0], less[twice]]), np.concatenate([keys[chosen == 0], less[~twice]])
    if len(keys) < need:
        raise Short
    return keys[chosen > 0], keys[chosen == 0]


# -- buckets -----------------------------------------------------------------------

_RAW = "part int, kind int, doc long, n long, blob binary"


def _emit(hot: np.ndarray, seed: int, parts: int, words: int):
    """Per slice of documents: each one's size, copies found in the task, and packed signatures by partition."""

    def run(batches):
        seen: dict[bytes, int] = {}
        for batch in batches:
            for start, length in _slices(batch.column(1)):
                cut = batch.slice(start, length)
                ids = cut.column(0).to_pylist()
                sizes, copies, docs, probes, others = [], [], [], [], []
                for ident, members in zip(ids, shingle_sets(cut.column(1), words), strict=True):
                    n = len(members)
                    sizes.append(n)
                    if not n or ident is None:
                        continue
                    mark = xxhash.xxh3_128_digest(members.tobytes()) + n.to_bytes(4, "little")
                    if len(seen) >= SEEN:
                        seen.clear()
                    first = seen.setdefault(mark, ident)
                    if first != ident:
                        copies.append((first, ident, n))
                        continue
                    band = band_of(n)
                    keys, rest = signatures(members, band, True, hot, seed)
                    if 4 * n >= 3 * (2 << band):  # within reach of the next band's smallest size
                        rest = np.concatenate([rest, signatures(members, band + 1, False, hot, seed)[1]])
                    docs.append((ident, n, len(keys), len(rest)))
                    probes.append(keys)
                    others.append(rest)
                yield _rows(np.arange(len(ids)) % parts, 0, ids, sizes, None)  # dealt evenly
                if copies:
                    yield _rows(np.arange(len(copies)) % parts, 1, [a for a, _, _ in copies], [b for _, b, _ in copies], None)
                if docs:
                    yield from _pack(docs, probes, others, parts)

    return run


def _rows(part, kind, doc, n, blob):
    size = len(part)
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(part, dtype=np.int32)), pa.array(np.full(size, kind, np.int32)), pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(blob, pa.binary()) if blob is not None else pa.nulls(size, pa.binary())], names=["part", "kind", "doc", "n", "blob"])


def _pack(docs, probes, others, parts):
    """One blob per partition: document numbers, sizes and flags run-length beside the bare keys."""
    table = np.array([d[:2] for d in docs], dtype=np.int64)
    counts = np.array([[d[2], d[3]] for d in docs])
    keys = np.concatenate([x for pair in zip(probes, others, strict=True) for x in pair])
    who = np.repeat(np.arange(len(docs) * 2), counts.ravel())  # twice the document's place, plus 1 for keys that do not probe
    part = (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    keys, who, part = keys[order], who[order], part[order]
    cuts = np.searchsorted(part, np.arange(parts + 1))
    blobs, places = [], []
    for p in range(parts):
        a, b = cuts[p], cuts[p + 1]
        if a == b:
            continue
        mine = who[a:b]
        heads = np.concatenate([[0], np.flatnonzero(np.diff(mine)) + 1])
        runs = mine[heads]
        head = np.empty(len(runs), dtype=[("doc", "<i8"), ("n", "<i4"), ("flag", "i1"), ("run", "<i4")])
        head["doc"], head["n"], head["flag"], head["run"] = table[runs >> 1, 0], table[runs >> 1, 1], runs & 1, np.diff(np.append(heads, b - a))
        blobs.append(len(runs).to_bytes(4, "little") + head.tobytes() + keys[a:b].tobytes())
        places.append(p)
    yield _rows(np.array(places, dtype=np.int32), 2, [None] * len(places), [None] * len(places), blobs)


_HEAD = np.dtype([("doc", "<i8"), ("n", "<i4"), ("flag", "i1"), ("run", "<i4")])
_BUCKETS = "kind int, doc long, n long, docs array<long>, sizes array<int>, probing int"


def _bucket_rows(kind, doc, n, docs, sizes, probing):
    size = len(kind)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(doc, pa.int64()) if doc is not None else pa.nulls(size, pa.int64()), pa.array(n, pa.int64()) if n is not None else pa.nulls(size, pa.int64()), pa.array(docs, pa.list_(pa.int64())) if docs is not None else pa.nulls(size, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())) if sizes is not None else pa.nulls(size, pa.list_(pa.int32())), pa.array(probing, pa.int32()) if probing is not None else pa.nulls(size, pa.int32())], names=["kind", "doc", "n", "docs", "sizes", "probing"])


def _meet(batches):
    """Buckets of equal keys: members (probing ones first) where some probe can link with another member."""
    keys, docs, sizes, flags = [], [], [], []
    for batch in batches:
        kind = batch.column(1).to_numpy()
        plain = batch.filter(pa.array(kind < 2))
        if plain.num_rows:
            yield _bucket_rows(plain.column(1), plain.column(2), plain.column(3), None, None, None)
        for blob in batch.filter(pa.array(kind == 2)).column(4).to_pylist():
            n = int.from_bytes(blob[:4], "little")
            head = np.frombuffer(blob, dtype=_HEAD, count=n, offset=4)
            keys.append(np.frombuffer(blob, dtype="<u8", offset=4 + n * _HEAD.itemsize))
            run = head["run"]
            docs.append(np.repeat(head["doc"], run))
            sizes.append(np.repeat(head["n"], run))
            flags.append(np.repeat(head["flag"], run))
    if not keys:
        return
    key = np.concatenate(keys)
    del keys
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    inside = np.zeros(len(key), dtype=bool)
    inside[1:] |= same
    inside[:-1] |= same
    order, key = order[inside], key[inside]
    doc, size, flag = np.concatenate(docs)[order], np.concatenate(sizes)[order], np.concatenate(flags)[order]
    del docs, sizes, flags
    order = np.lexsort((doc, flag, key))
    key, doc, size, flag = key[order], doc[order], size[order], flag[order]
    cuts = np.append(np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1]), len(key)) if len(key) else np.zeros(1, dtype=np.int64)
    made: dict[bytes, tuple] = {}
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if flag[a]:
            continue  # nobody probes
        ids, first = np.unique(doc[a:b], return_index=True)
        if len(ids) < 2:
            continue
        pick = np.sort(first) + a  # a document's probing entry stands before its others
        ids, n, probing = doc[pick], size[pick], int((flag[pick] == 0).sum())
        if b - a == 2 and DEN * n.min() < NUM * n.max():
            continue
        mark = ids.tobytes() + probing.to_bytes(4, "little")
        made.setdefault(mark, (ids, n, probing))
        if len(made) >= 20_000:
            rows = list(made.values())
            made.clear()
            yield _bucket_rows(np.full(len(rows), 2, np.int32), None, None, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])
    if made:
        rows = list(made.values())
        yield _bucket_rows(np.full(len(rows), 2, np.int32), None, None, [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])


# -- pairs -------------------------------------------------------------------------


def sketch(members: np.ndarray) -> np.ndarray:
    """Parities of how many members fall in each of 4 * 2**band cells (64 at least), packed in words.

    The number of cells that differ between two sets is at most the number of members that do,
    so too many differing cells rule a link out; folding halves together keeps that true.
    """
    cells = max(64, 4 << band_of(len(members)))
    count = np.bincount((mix64(members) & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((count & 1).astype(np.uint8)).view("<u8")


def fold(sketches: list[np.ndarray]) -> np.ndarray:
    """Sketches as rows of one length, that of the shortest."""
    width = min(len(x) for x in sketches)
    out = np.zeros((len(sketches), width), dtype=np.uint64)
    for row, x in zip(out, sketches, strict=True):
        row[:] = np.bitwise_xor.reduce(x.reshape(-1, width), axis=0)
    return out


def _open(k: int, others: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Those of ``others`` that size and sketch allow to link with ``k``."""
    n, m = sizes[k], sizes[others]
    others = others[DEN * np.minimum(n, m) >= NUM * np.maximum(n, m)]
    apart = np.bitwise_count(rows[others] ^ rows[k]).sum(1)
    return others[apart <= (n + sizes[others]) * (DEN - NUM) // (DEN + NUM)]


def resolve(docs: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], marks: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links among a bucket's members that join its components; pairs of one component are not tested."""
    order = np.argsort(labels, kind="stable")
    sizes, rows = np.array([len(x) for x in sets]), fold(marks)
    names, own = np.unique(labels, return_inverse=True)
    links = []
    for i, k in enumerate(order.tolist()):
        later = order[i + 1 :]
        for j in _open(k, later[own[later] != own[k]], sizes, rows).tolist():
            if own[j] != own[k] and linked(sets[k], sets[j]):
                links.append((int(docs[k]), int(docs[j])))
                own[own == own[j]] = own[k]
    return links


def _resolve(table: pa.Table) -> pa.Table:
    docs, first = np.unique(table.column("doc").to_numpy(), return_index=True)
    table = table.take(pa.array(first))
    column = table.column("members").combine_chunks()
    flat, cuts = column.values.to_numpy(), column.offsets.to_numpy().tolist()
    sets = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    marks = [np.frombuffer(x, dtype="<u8") for x in table.column("mark").to_pylist()]
    links = resolve(docs, table.column("label").to_numpy(), sets, marks) if len(docs) > 1 else []
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _cross(table: pa.Table) -> pa.Table:
    """Pairs of a bucket that probes, sizes, components and sketches leave open."""
    docs, first = np.unique(table.column("doc").to_numpy(), return_index=True)
    table = table.take(pa.array(first))
    labels, probe, left = (table.column(c).to_numpy(zero_copy_only=False) for c in ("label", "probe", "left"))
    sizes, rows = table.column("size").to_numpy(), fold([np.frombuffer(x, dtype="<u8") for x in table.column("mark").to_pylist()])
    one, two = [], []
    for k in np.flatnonzero(probe).tolist():
        others = np.flatnonzero((labels != labels[k]) & (sizes <= sizes[k]) & (~probe | (sizes < sizes[k]) | (np.arange(len(docs)) > k)))
        others = others[left[others] != left[k]] if left.any() and not left.all() else others
        for j in _open(k, others, sizes, rows).tolist():
            one.append(min(docs[k], docs[j]))
            two.append(max(docs[k], docs[j]))
    return pa.table({"a": pa.array(one, pa.int64()), "b": pa.array(two, pa.int64())})


def linked(one: np.ndarray, two: np.ndarray) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return bool(both) and DEN * both >= NUM * (len(one) + len(two) - both)


def _sets_of(words: int):
    def run(batches):
        for batch in batches:
            for start, length in _slices(batch.column(1)):
                cut = batch.slice(start, length)
                sets = shingle_sets(cut.column(1), words)
                marks = pa.array([sketch(x).tobytes() for x in sets], pa.binary())
                members = pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([cut.column(0), members, marks], names=["doc", "members", "mark"])

    return run


def _hot(docs: DataFrame, words: int) -> np.ndarray:
    """Sorted hashes of n-grams that are common in a bounded sample."""

    def run(batches):
        count: dict[int, int] = {}
        for batch in batches:
            for start, length in _slices(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(start, length), words)
                values, n = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
                for v, k in zip(values.tolist(), n.tolist(), strict=True):
                    count[v] = count.get(v, 0) + k
        common = sorted((v for v, k in count.items() if k >= HOT_DOCS), key=lambda v: -count[v])[:50_000]
        yield pa.RecordBatch.from_arrays([pa.array([np.array(sorted(common), dtype="<u8").tobytes()], pa.binary())], names=["common"])

    sample = docs.where(F.pmod(F.xxhash64("_id"), F.lit(16)) == 0).limit(HOT_SAMPLE).coalesce(1)
    found = [np.frombuffer(r.common, dtype="<u8") for r in sample.mapInArrow(run, "common binary").collect()]
    return np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Per row with an id: id, ``n_shingles``, ``component_id`` (smallest id reachable by links, itself included).

    Two documents link when the Jaccard similarity of their n-gram sets is at least 3/4. Null
    and wordless texts have the empty set and link with nothing. Ids must be integers; rows with
    a null id come back with a null component; rows that repeat an id count once in links and
    each give a row. An empty table gives an empty one; other columns are ignored.

    One pass over the texts sends packed signatures (about 8 bytes each, two for three n-grams)
    to the partition of their key; copies within a map task send one set. A partition sorts its keys
    and keeps member lists of shared ones, each list once. Then rounds: every document goes with its
    exact set to its largest bucket that still holds several components, where links are found and joined
    at once, so a group is not squared when a few links already join it. The last
    round tests each pair that is still open in any bucket, sketches first, so no link is lost.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    hot, parts = _hot(rows, words), _parts(rows)
    seed = 0
    while True:
        try:
            raw = rows.mapInArrow(trimmed(_emit(hot, seed, parts, words)), _RAW)
            found = stored(raw.repartitionById(parts, F.col("part")).mapInArrow(trimmed(_meet), _BUCKETS), "buckets")
            break
        except Exception as failed:
            if _SHORT not in str(failed) or seed >= 8:
                raise
            seed += 1
    lists = stored(found.where("kind = 2").select("docs", "sizes", "probing").distinct().withColumn("bucket", F.monotonically_increasing_id()), "lists")
    member = stored(lists.select(F.explode("docs").alias("doc")).distinct(), "members")
    few = member.count() <= BROADCAST_IDS
    sets = stored(rows.join(F.broadcast(member) if few else member, rows["_id"] == member["doc"], "left_semi").mapInArrow(trimmed(_sets_of(words)), "doc long, members array<long>, mark binary"), "sets")
    weight = sets.agg(F.coalesce(F.sum(F.octet_length("mark")), F.lit(0)).alias("bytes")).first().bytes
    if few and weight <= BROADCAST_SKETCHES:
        before, lists = lists, stored(_thinned(lists, sets).distinct().withColumn("bucket", F.monotonically_increasing_id()), "lists")
        discard(before)
    copies, edges = _split_copies(found, member)
    labels, places = components(edges), None
    for round_ in range(ROUNDS + 1):
        before, lists = lists, stored(_still_open(lists, labels.join(member, labels["node"] == member["doc"], "left_semi"), places, few), "lists")
        discard(before)
        if not lists.limit(1).count():
            break
        if places is not None:
            discard(places)
        if round_ < ROUNDS:
            places = _places(lists, round_)
            new = _settle(places, labels, sets, few)
        else:
            new = _exhaust(lists, labels, sets, few)
        old, edges = (edges, labels), stored(edges.unionByName(new), "links")
        labels = components(edges)
        for used in old:
            discard(used)
        trim()
    for used in (lists, member, sets, edges, *([places] if places is not None else [])):
        discard(used)
    sizes = found.where("kind = 0").select(F.col("doc").alias("_id"), F.col("n").alias("n_shingles"))
    named = _with_copies(labels, copies)
    return sizes.join(named, sizes["_id"] == named["node"], "left").select(F.col("_id").alias(id_col), "n_shingles", F.coalesce("label", "_id").alias("component_id"))


def _parts(rows: DataFrame) -> int:
    """Partitions of signatures: the session's shuffle partitions, or more where the input's files are large.

    The size is the optimizer's estimate; from a petabyte on it stands for "unknown" and counts for nothing.
    """
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = min(MOST_PARTS, size // PART_BYTES) if size < 1 << 50 else 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted)


def _split_copies(found: DataFrame, member: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(copies that only follow the document they repeat, edges to start from).

    A map task's copies (a: the document that stands for them, b) need no part in the rounds. Only
    where an id repeats can a copy have a link of its own (it stands for others, is in a bucket
    or copies several); those are edges.
    """
    copies = found.where("kind = 1").select(F.col("doc").alias("a"), F.col("n").alias("b")).distinct()
    roles = copies.select(F.col("b").alias("doc")).union(copies.select("a").distinct()).union(member.select("doc"))
    several = stored(roles.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc").join(copies.select("b").distinct(), F.col("doc") == F.col("b"), "left_semi"), "repeated-ids")
    return copies.join(several, copies["b"] == several["doc"], "left_anti"), stored(copies.join(several, copies["b"] == several["doc"], "left_semi"), "links")


def _with_copies(labels: DataFrame, copies: DataFrame) -> DataFrame:
    """(node, label) of all documents with links or copies: the smallest id of a component, its copies included."""
    low = copies.groupBy("a").agg(F.min("b").alias("low"))
    own = labels.join(low, labels["node"] == low["a"], "full_outer").select(F.coalesce("node", "a").alias("node"), F.coalesce("label", "a").alias("part"), "low")
    own = own.select("node", "part", F.least("node", "low").alias("low"))  # least() passes over a null
    own = stored(own.join(own.groupBy(F.col("part").alias("of")).agg(F.min("low").alias("label")), F.col("part") == F.col("of")).select("node", "label"), "labels")
    return own.union(copies.join(own, copies["a"] == own["node"]).select("b", "label"))


def _lookup(spark, table: DataFrame, key: str, values: list[str]):
    """A small table as a broadcast of sorted keys and their values."""
    got = table.select(key, *values).toArrow()
    keys = got.column(0).to_numpy()
    order = np.argsort(keys)
    return spark.sparkContext.broadcast((keys[order], [got.column(k + 1).to_numpy()[order] for k in range(len(values))]))


def _found(shared, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the broadcast keys, which of ``wanted`` are there)."""
    keys = shared.value[0]
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _still_open(lists: DataFrame, labels: DataFrame, places: DataFrame | None, few: bool) -> DataFrame:
    """The buckets that hold several components and whose members did not all meet in one place of the last round."""
    spark = lists.sparkSession
    if not few:
        flat = lists.select("bucket", F.explode("docs").alias("doc"))
        flat = flat.join(labels, flat["doc"] == labels["node"], "left").select("bucket", "doc", F.coalesce("label", "doc").alias("label"))
        meet = F.lit(False)
        if places is not None:
            flat = flat.join(places, "doc", "left").select("bucket", "label", F.struct("at", "chunk").alias("place"))
            meet = F.bool_and(F.col("place.at").isNotNull()) & (F.min("place") == F.max("place"))
        left = flat.groupBy("bucket").agg((F.min("label") < F.max("label")).alias("several"), meet.alias("met")).where("several AND NOT met")
        return lists.join(left, "bucket", "left_semi").select("docs", "sizes", "probing", "bucket")
    named = _lookup(spark, labels, "node", ["label"])
    placed = None if places is None else _lookup(spark, places, "doc", ["at", "chunk"])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(0)
            docs, cuts = column.flatten().to_numpy(), column.offsets.to_numpy()
            starts = cuts[:-1] - cuts[0]
            at, there = _found(named, docs)
            label = np.where(there, named.value[1][0][at], docs) if there.any() else docs
            keep = np.minimum.reduceat(label, starts) < np.maximum.reduceat(label, starts)
            if placed is not None:
                at, there = _found(placed, docs)
                apart = ~np.logical_and.reduceat(there, starts)
                for value in placed.value[1]:
                    mine = value[at] if len(value) else docs
                    apart |= np.minimum.reduceat(mine, starts) < np.maximum.reduceat(mine, starts)
                keep &= apart
            yield batch.filter(pa.array(keep))

    return lists.mapInArrow(run, lists.schema)


def split_bucket(sizes: np.ndarray, probing: int, marks: list[np.ndarray]) -> list[np.ndarray]:
    """A bucket's members by the components of the pairs that probes, sizes and sketches leave possible."""
    rows, own = fold(marks), np.arange(len(sizes))
    for k in range(probing):
        others = np.flatnonzero((own != own[k]) & (sizes <= sizes[k]))
        for j in _open(k, others, sizes, rows).tolist():
            if own[j] != own[k]:
                own[own == own[j]] = own[k]
    names, count = np.unique(own, return_counts=True)
    return [np.flatnonzero(own == name) for name in names[count > 1]]


def _thinned(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """``lists`` cut into the parts in which links are possible; every link stays within a part."""
    got = sets.select("doc", "mark").toArrow()
    docs, first = np.unique(got.column(0).to_numpy(), return_index=True)
    marks = got.column(1).combine_chunks().take(pa.array(first))
    flat = np.frombuffer(b"".join(marks.to_pylist()), dtype="<u8")
    cuts = np.concatenate([[0], np.cumsum(pc.binary_length(marks).to_numpy(zero_copy_only=False) // 8)]).astype(np.int64)
    shared = lists.sparkSession.sparkContext.broadcast((docs, cuts, flat))

    def run(batches):
        keys, at, words = shared.value
        for batch in batches:
            made: list[list] = [[], [], []]
            for ids, sizes, probing in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                ids, sizes = ids.values.to_numpy(), sizes.values.to_numpy().astype(np.int64)
                place = np.searchsorted(keys, ids)
                for part in split_bucket(sizes, probing, [words[at[p] : at[p + 1]] for p in place.tolist()]):
                    made[0].append(ids[part])
                    made[1].append(sizes[part].astype(np.int32))
                    made[2].append(int((part < probing).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(made[0], pa.list_(pa.int64())), pa.array(made[1], pa.list_(pa.int32())), pa.array(made[2], pa.int32())], names=["docs", "sizes", "probing"])

    return lists.select("docs", "sizes", "probing").mapInArrow(trimmed(run), "docs array<long>, sizes array<int>, probing int")


def _members(lists: DataFrame) -> DataFrame:
    """One row per bucket and member: bucket, width, load, doc, size, probe."""
    place = F.arrays_zip("docs", "sizes", F.sequence(F.lit(1), F.size("docs")).alias("pos"))
    flat = lists.select("bucket", "probing", F.size("docs").alias("width"), F.expr("aggregate(sizes, 0L, (a, x) -> a + x)").alias("load"), F.explode(place).alias("x"))
    return flat.select("bucket", "width", "load", F.col("x.docs").alias("doc"), F.col("x.sizes").cast("long").alias("size"), (F.col("x.pos") <= F.col("probing")).alias("probe"))


def _labelled(rows: DataFrame, labels: DataFrame, few: bool) -> DataFrame:
    """``rows`` (with doc) and the component of each doc so far."""
    named = labels.select(F.col("node").alias("_n"), "label")
    return rows.join(F.broadcast(named) if few else named, F.col("doc") == F.col("_n"), "left").withColumn("label", F.coalesce("label", "doc")).drop("_n")


def _places(lists: DataFrame, round_: int) -> DataFrame:
    """(doc, at, chunk): the open bucket where each document goes in this round, cut into chunks that fit a task.

    In the first round that is its largest bucket; then the one of least hash, where documents
    with mostly the same buckets meet.
    """
    rank = F.col("width").cast("long") if round_ == 0 else F.xxhash64("bucket", F.lit(round_))
    best = _members(lists).groupBy("doc").agg(F.max(F.struct(rank.alias("rank"), "bucket", "width", "load")).alias("x"))
    chunks = F.greatest(F.ceil(F.col("x.load") / CHUNK_MEMBERS), F.ceil(F.col("x.width") / CHUNK_DOCS))
    return stored(best.select("doc", F.col("x.bucket").alias("at"), F.pmod(F.xxhash64("doc", F.lit(round_)), chunks).alias("chunk")), "places")


def _settle(places: DataFrame, labels: DataFrame, sets: DataFrame, few: bool) -> DataFrame:
    """Links found among the documents of each place."""
    side = _labelled(places, labels, few)
    met = sets.join(F.broadcast(side) if few else side, "doc")
    return met.select("at", "chunk", "doc", "label", "members", "mark").groupBy("at", "chunk").applyInArrow(_resolve, "a long, b long")


def _exhaust(lists: DataFrame, labels: DataFrame, sets: DataFrame, few: bool) -> DataFrame:
    """Links among all pairs that any bucket leaves open.

    A bucket's pairs are cut into blocks of at most ``BLOCK_DOCS`` by ``BLOCK_DOCS`` documents. Members of its
    largest component meet the others, never one another; so a hot bucket that rounds have
    joined but for a few costs its width, not its square.
    """
    flat = _labelled(_members(lists), labels, few)
    counts = flat.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    tops = counts.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("x"), F.sum("n").alias("whole"))
    blocks = lambda n: F.ceil(n / BLOCK_DOCS)
    tops = tops.select("bucket", F.col("x.label").alias("top"), blocks(F.col("x.n")).alias("n_top"), blocks(F.col("whole") - F.col("x.n")).alias("n_rest"))
    wide = lists.count() > BROADCAST_IDS  # a row per bucket still open; a hot bucket's members stay where they are
    marks = flat.join(tops if wide else F.broadcast(tops), "bucket").join(sets.select("doc", "mark"), "doc").withColumn("left", F.col("label") == F.col("top"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    own = F.pmod(F.xxhash64("doc"), F.when(F.col("left"), F.col("n_top")).otherwise(F.col("n_rest")))
    against = marks.withColumn("own", own).withColumn("other", F.explode(upto(F.when(F.col("left"), F.col("n_rest")).otherwise(F.col("n_top")))))
    against = against.withColumns({"kind": F.lit(0), "c0": F.when(F.col("left"), F.col("own")).otherwise(F.col("other")), "c1": F.when(F.col("left"), F.col("other")).otherwise(F.col("own"))})
    rest = marks.where("NOT left").withColumn("own", own).withColumn("other", F.explode(upto(F.col("n_rest"))))
    rest = rest.withColumns({"kind": F.lit(1), "c0": F.least("own", "other"), "c1": F.greatest("own", "other"), "left": F.col("own") < F.col("other")})
    shape = ["bucket", "kind", "c0", "c1", "doc", "size", "probe", "label", "mark", "left"]
    pairs = stored(against.select(*shape).unionByName(rest.select(*shape)).groupBy("bucket", "kind", "c0", "c1").applyInArrow(_cross, "a long, b long").distinct(), "pairs")
    one = pairs.join(sets.select(F.col("doc").alias("a"), F.col("members").alias("x")), "a")
    both = one.join(sets.select(F.col("doc").alias("b"), F.col("members").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))  # a row at a time, however long the sets are
    return both.where((shared > 0) & (DEN * shared >= NUM * (F.size("x") + F.size("y") - shared))).select("a", "b")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, whatever their names: of each component the rows of the smallest id.

    Rows of a null id stay, rows that repeat an id stay or go together (exact copies are another operator's
    job), rows without words stay; an empty table stays empty.
    """
    linked_docs = link_documents(docs, id_col, text_col)
    gone = fresh("_gone", docs.columns)
    dropped = linked_docs.where(F.col(f"`{id_col}`") != F.col("component_id")).select(F.col(f"`{id_col}`").alias(gone)).distinct()
    return docs.join(dropped, docs[f"`{id_col}`"] == dropped[gone], "left_anti")
