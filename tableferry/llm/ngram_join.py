"""Exact similarity join on word shingles by PartEnum signatures.

Two sets of Jaccard similarity t or more differ in at most k = (a + b) (1 - t) / (1 + t)
elements, a and b being their sizes. Sizes are cut into bands, so that partners lie in the same
or in neighbouring bands; every set signs for its own band and for the next. For a band the
domain of elements is cut into more than k parts by hash: at most k parts can differ, so
similar sets agree on a part. A signature is the band, the part's number and the set's elements
in the part. (Of the parts, one is taken at a time: the subsets of size one at second level.)

Only as many parts are signed as the pigeonhole needs: of the first k + c parts that are not
empty, similar sets agree on c. As this holds for both sets, it holds within the smaller number
of parts. Sets of any size share one signature at least, larger ones ``SHARED``.

For large sets so many parts hold few elements each, and two long texts with one passage in common would
share some. There the domain is cut into fewer parts, as few as still leave one untouched in all but
one of 2**64 cases when the differences fall on parts at random, as hashes do; all parts that are
not empty are signed. (So results are exact as far as comparing by 64-bit hashes is.)

Elements that many sets hold are left out of all parts, which keeps the bound: fewer elements
cannot differ in more. A set with too few elements left signs again with more common ones, tier
by tier, each tier a space of its own, and in the end with each of its rarest elements by itself (prefix filter). A set signs
in all tiers up to the first that suffices, so similar sets meet in the lower of theirs.

Sets that share enough signatures are tied. Tasks pack their signatures by shard of the signature space. Where few
sets have a signature, the pairs whose sizes allow a link are counted over all shards, and tied when they share as
many as similar sets do; where many have it, all are tied to one of them, without pairs. The connected groups of ties hold
all links. A group is compared in tasks: as a whole, or, if its sets are many, by pairs of blocks. A task compares its
sets exactly by counting, leaves out pairs that sizes exclude or that are connected already, and
returns a forest of links. So no step writes pairs as rows: what is sent is one row per set and block of its group,
and what comes back is less than one per set.

A set is named by a 64-bit hash of its elements, so equal texts are one node and an id with several texts is several.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import if_small, kept, tidy
from tableferry.llm.components import components
from tableferry.llm.hashing import SPACES, Words, mixed, slices, windows, word_table

TABLE = word_table(lambda b: b not in SPACES, lower=True)
SHINGLE = 5
#: Similarity as a fraction, so that all comparisons are in whole numbers.
SIMILAR = (3, 4)
#: A shingle is common when this many sets hold it, and in each further tier when so many times
#: more do. The most frequent COMMON_MOST are known to all tasks (12 MB); any set of common
#: shingles gives the same result.
COMMON_LEAST = 16
TIER = 4
COMMON_MOST = 1_000_000
#: Within one chunk, shingles of fewer sets are not counted towards it.
LOCAL_LEAST = 3
SIGNATURE_BYTES = 5
#: Bytes of a shingle's hash that sets are compared by, and elements in a block of comparisons.
ELEMENT_BYTES = 6
BLOCK_ELEMENTS = 300_000
#: Signatures that similar sets share at least, if both have SHARED_FROM elements.
SHARED, SHARED_FROM = 4, 24
#: Where parts are cut by chance, all are hit for one of 2**MISS_BITS pairs, and all but SHARED for one of 2**64.
MISS_BITS = 80
#: Sets with one signature whose pairs are counted; more are tied to one.
FEW = 100
#: Pairs that are gathered before equal ones are counted together.
GATHERED = 4_000_000
#: Sets whose ties are brought together in one task.
TIED_SETS = 50_000
#: A chunk of documents that is signed together, and signatures per shard.
CHUNK_SHINGLES = 3_000_000
CHUNK_TEXTS = 30_000
SHARD_SIGNATURES = 4_000_000


class Sets:
    """Sorted distinct shingles of texts, one after another."""

    def __init__(self, size: int):
        self.size, self.words = size, Words(TABLE)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        hashes, starts = self.words(texts)
        shingles, n = windows(hashes, self.size), self.size
        out = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a >= n:
                out.append(np.unique(shingles[a: b - n + 1]))
            elif b > a:  # the whole sequence, told from any shingle by its length
                out.append(mixed(windows(hashes[a:b], b - a) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def filled_needed(parts: int, k: int) -> int:
    """How many of the parts must not be empty, so that ``k`` differences, falling on parts at random, miss SHARED of them.

    Each part is missed with the same chance, and that all are hit is no likelier than if parts were independent.
    """
    return math.ceil(MISS_BITS * math.log(2) / -math.log1p(-((1 - 1 / parts) ** k)))


def parts_by_chance(cases: list[tuple[int, int]], upto: int) -> int:
    """The fewest parts that serve sets of all these (size, differences), 0 if they would be more than ``upto``.

    A fifth of a set's elements may be common ones that are left out.
    """
    def serves(parts: int) -> bool:
        for size, k in cases:
            empty = math.exp(-0.8 * size / parts)
            if (1 - 1 / parts) ** k < 1e-12 or filled_needed(parts, k) > parts * (1 - empty) - 3 * math.sqrt(parts * empty):
                return False
        return True

    if upto < 16 or not serves(upto):
        return 0
    low, high = 16, upto
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if serves(middle) else (middle + 1, high)
    return low


class Bands:
    """Bands of set sizes; for each the number of parts and the bound on differences."""

    def __init__(self, similar: tuple[int, int] = SIMILAR, upto: int = 1 << 40):
        self.num, self.den = similar
        first, self.last, self.parts, self.shared, self.chance = [], [], [], [], []
        low = 1
        while low < upto:
            high = low * self.den // self.num
            k = self.differ(high, high)
            first.append(low)
            self.last.append(high)
            self.shared.append(1 if high < SHARED_FROM else SHARED)
            # A quarter more parts than are signed; small sets get more, to be told apart at all.
            signed = k + self.shared[-1]
            before = first[-2] if len(first) > 1 else low
            parts = parts_by_chance([(high, k), (before, self.differ(before, before * self.den // self.num))], signed * 3 // 4)
            self.parts.append(parts or max(signed + signed // 4 + 4, min(24, 12 * (k + 1))))
            self.chance.append(parts > 0)
            low = high + 1
        self.first, self.last, self.shared = np.array(first), np.array(self.last), np.array(self.shared)

    def differ(self, a, b):
        """Most elements in which similar sets of sizes ``a`` and ``b`` can differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.first, size, "right")) - 1

    def signatures(self, elements: np.ndarray, common: "Common") -> np.ndarray:
        """All signatures of one set."""
        size, out = len(elements), []
        own, frequency = self.of(size), common.frequency(elements)
        for band in (own, own + 1):
            k = self.differ(size, min(int(self.last[band]), size * self.den // self.num))
            enough = filled_needed(self.parts[band], k) if self.chance[band] else k + int(self.shared[band])
            wanted = None if self.chance[band] else enough
            for space, bound in enumerate((*common.bounds, None)):
                found = self._signed(elements if bound is None else elements[frequency < bound], band, wanted, space)
                out.append(found)
                if len(found) >= enough:
                    break
            else:
                # Of the rarest elements, similar sets that come here share as many as of signatures.
                rarest = np.lexsort((elements, frequency))[: size - -(-size * self.num // self.den) + int(self.shared[band])]
                out.append(mixed(elements[rarest] ^ np.uint64(3 + 4 * band)))
        return np.concatenate(out)

    def _signed(self, elements: np.ndarray, band: int, wanted: int | None, space: int) -> np.ndarray:
        """Signatures of the first ``wanted`` parts that are not empty, or of all if they are fewer or None is given."""
        parts = self.parts[band]
        seed = np.uint64(((64 * band + space + 1) * 0xD1B54A32D192ED03) % (1 << 64))
        spread = mixed(elements ^ seed)
        part = (((spread >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, spread)
        filled = np.flatnonzero(np.bincount(part, minlength=parts))[:wanted]
        return mixed(sums[filled] ^ mixed(filled.astype(np.uint64) + seed))


class Common:
    """Common shingles and how many sets hold them at least."""

    def __init__(self, counts: dict[int, int]):
        self.shingles = np.sort(np.array(list(counts), np.int64).view(np.uint64))
        self.counts = np.array([counts[x] for x in self.shingles.view(np.int64).tolist()], np.int64)
        #: Shingles of so many sets or more are left out, tier by tier.
        self.bounds, bound = [], COMMON_LEAST
        while len(self.counts) and bound <= self.counts.max():
            self.bounds.append(bound)
            bound *= TIER

    def frequency(self, elements: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.zeros(len(elements), np.int64)
        at = np.minimum(np.searchsorted(self.shingles, elements), len(self.shingles) - 1)
        return np.where(self.shingles[at] == elements, self.counts[at], 0)


def _node(elements: np.ndarray) -> int:
    """The name of a set."""
    return int.from_bytes(hashlib.blake2b(elements.tobytes(), digest_size=8).digest(), "little", signed=True)


NAMES = ["doc_id", "n_shingles", "node", "shingle", "n_sets"]


def set_table(documents: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, node) of every row, and (shingle, n_sets) of shingles frequent in a chunk."""
    def read(batches):
        sets, chunk, seen = Sets(shingle), [], set()

        def frequent():
            found, counts = np.unique(np.concatenate(chunk), return_counts=True) if chunk else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            often = counts >= LOCAL_LEAST
            chunk.clear()
            seen.clear()
            n = int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(found[often].view(np.int64)), pa.array(counts[often], pa.int64())],
                names=NAMES)

        size = 0
        for batch in slices(batches):
            nodes, sizes = [], []
            for elements in sets(batch.column(1)):
                nodes.append(_node(elements))
                sizes.append(len(elements))
                if nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    chunk.append(elements)
                    size += len(elements)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=NAMES)
            if size >= CHUNK_SHINGLES:
                yield frequent()
                size = 0
        yield frequent()

    return documents.mapInArrow(tidy(read), "doc_id bigint, n_shingles bigint, node bigint, shingle bigint, n_sets bigint")


PACKED = "shard int, nodes binary, sizes binary, signatures binary, owners binary, ties binary"
#: Marks an owner that stands for more than FEW sets of its chunk.
MANY = 1 << 15


def signature_table(documents: DataFrame, shingle: int, similar, common, shards: int) -> DataFrame:
    """Signatures of chunks of documents (doc_id, text), packed by shard.

    Equal sets of a chunk sign once; of more than FEW sets with one signature the first is kept and tied to the others.
    """
    def sign(batches):
        sets, bands = Sets(shingle), Bands(similar)
        frequent = common.value
        nodes, sizes, found, seen, size = [], [], [], set(), 0

        def packed():
            owner = np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])
            signs = np.concatenate(found)
            order = np.argsort(signs, kind="stable")
            signs, owner = signs[order], owner[order]
            begin, place = runs(signs)
            many = np.bincount(begin, minlength=len(signs))[begin] > FEW
            key, rest = np.array(nodes, np.int64), np.flatnonzero(many & (place > 0))
            tied = forest(len(key), owner[begin[rest]], owner[rest])
            ties = np.column_stack((key[tied], key))[tied != np.arange(len(key))]
            stay = ~many | (place == 0)
            signs, owner, many = signs[stay], owner[stay], many[stay]
            # The top bits choose the shard, the low 40 bits are sent; a chance collision is one more tie.
            shard = ((signs >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
            cut = np.searchsorted(shard, np.arange(shards + 1))
            low = signs.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SIGNATURE_BYTES]
            rows = {name: [] for name in ("shard", "nodes", "sizes", "signatures", "owners", "ties")}
            for n in range(shards):
                own = owner[cut[n]: cut[n + 1]]
                if len(own) or (n == 0 and len(ties)):
                    used, place = np.unique(own, return_inverse=True)
                    rows["shard"].append(n)
                    rows["nodes"].append(key[used].tobytes())
                    rows["sizes"].append(np.array(sizes, np.int64)[used].astype(np.int32).tobytes())
                    rows["signatures"].append(low[cut[n]: cut[n + 1]].tobytes())
                    rows["owners"].append((place + many[cut[n]: cut[n + 1]] * MANY).astype(np.uint16).tobytes())
                    rows["ties"].append(ties.tobytes() if n == 0 else b"")
            for x in (nodes, sizes, found, seen):
                x.clear()
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema([("shard", pa.int32()), *((name, pa.binary()) for name in list(rows)[1:])]))

        for batch in slices(batches):
            for elements in sets(batch.column(1)):
                if not len(elements) or (node := _node(elements)) in seen:
                    continue
                seen.add(node)
                nodes.append(node)
                sizes.append(len(elements))
                found.append(bands.signatures(elements, frequent))
                size += len(elements)
                if size >= CHUNK_SHINGLES or len(nodes) >= CHUNK_TEXTS:
                    yield packed()
                    size = 0
        if found:
            yield packed()

    return documents.mapInArrow(tidy(sign), PACKED)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted values, where each one's run of equals begins, and its place in the run."""
    at = np.arange(len(values))
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    begin = np.maximum.accumulate(np.where(first, at, 0)) if len(values) else at
    return begin, at - begin


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest one that the ties a-b connect it with."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:  # every node points to its root
            further = root[root]
            if np.array_equal(further, root):
                break
            root = further
    return root


class Tally:
    """Counts pairs of places below 2**32, a bounded number at a time."""

    def __init__(self):
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.fresh, self.size = [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for at in range(0, len(a), GATHERED):
            x, y = a[at: at + GATHERED], b[at: at + GATHERED]
            self.fresh.append(np.minimum(x, y) << 32 | np.maximum(x, y))
            self.size += len(x)
            if self.size >= GATHERED:
                self._merge()

    def _merge(self) -> None:
        codes, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *self.fresh]), return_counts=True)
        self.fresh, self.size = [], 0
        merged, place = np.unique(np.concatenate((self.codes, codes)), return_inverse=True)
        self.counts = np.bincount(place, np.concatenate((self.counts, counts)), len(merged)).astype(np.int64)
        self.codes = merged

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._merge()
        return self.codes >> 32, self.codes & 0xFFFFFFFF, self.counts


def tied_sets(signatures: DataFrame, similar, parts: int) -> DataFrame:
    """(a, b): ties that connect all sets that share enough signatures; pairs are counted in ``parts`` parts."""
    num, den = similar
    bands = Bands(similar)

    def tie(table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_pylist() for name in table.column_names}
        own = [np.frombuffer(x, np.int64) for x in columns["nodes"]]
        base = np.cumsum([0, *map(len, own)])
        ties = np.frombuffer(b"".join(columns["ties"]), np.int64)
        nodes, place = np.unique(np.concatenate([*own, ties]), return_inverse=True)
        sizes = np.zeros(len(nodes), np.int64)
        sizes[place[: base[-1]]] = np.frombuffer(b"".join(columns["sizes"]), np.int32)
        owner = [np.frombuffer(x, np.uint16).astype(np.int64) for x in columns["owners"]]
        many = np.concatenate(owner) >= MANY
        owner = place[np.concatenate([x % MANY + b for x, b in zip(owner, base, strict=False)])]
        signs = np.zeros((len(owner), 8), np.uint8)
        signs[:, :SIGNATURE_BYTES] = np.frombuffer(b"".join(columns["signatures"]), np.uint8).reshape(-1, SIGNATURE_BYTES)
        signs = signs.view("<u8")[:, 0]
        order = np.lexsort((owner, signs))
        signs, owner, many = signs[order], owner[order], many[order]
        # A set that several chunks have signs once.
        once = np.ones(len(signs), bool)
        once[1:] = (signs[1:] != signs[:-1]) | (owner[1:] != owner[:-1])
        begin, _ = runs(signs)
        crowd = np.bincount(begin, many, minlength=len(signs))[begin] > 0
        signs, owner, crowd = signs[once], owner[once], crowd[once]
        begin, at = runs(signs)
        size = np.bincount(begin, minlength=len(signs))[begin]
        crowd |= size > FEW
        rest = np.flatnonzero(crowd & (at > 0))
        given = place[len(place) - len(ties):].reshape(-1, 2)
        root = forest(len(nodes), np.append(owner[begin[rest]], given[:, 0]), np.append(owner[rest], given[:, 1]))
        some = np.flatnonzero(root != np.arange(len(nodes)))
        tally, here = Tally(), np.flatnonzero(~crowd & (size > 1))
        for step in range(1, FEW):
            here = here[at[here] + step < size[here]]
            x, y = owner[here], owner[here + step]
            fit = (np.minimum(sizes[x], sizes[y]) * den >= np.maximum(sizes[x], sizes[y]) * num) & (root[x] != root[y])
            tally.add(x[fit], y[fit])
        x, y, counts = tally.pairs()
        low, high = np.minimum(sizes[x], sizes[y]), np.maximum(sizes[x], sizes[y])
        least = np.where(low < SHARED_FROM, 1, bands.shared[np.searchsorted(bands.first, high, "right") - 1])
        a, b = nodes[np.append(root[some], x)], nodes[np.append(some, y)]
        lacks = np.append(np.zeros(len(some), np.int64), least)
        counts = np.append(np.ones(len(some), np.int64), np.minimum(counts, 255))
        order = np.argsort(part := b % parts, kind="stable")
        cut = np.searchsorted(part[order], np.arange(parts + 1))
        used = np.flatnonzero(np.diff(cut))
        piece = lambda x: pa.array([x[order[cut[n]: cut[n + 1]]].tobytes() for n in used], pa.binary())
        return pa.table({"part": pa.array(used, pa.int64()), "a": piece(a), "b": piece(b), "shared": piece(counts.astype(np.uint8)), "least": piece(lacks.astype(np.uint8))})

    def join(table: pa.Table) -> pa.Table:
        a, b, shared, least = (np.frombuffer(b"".join(table.column(n).to_pylist()), kind) for n, kind in enumerate((np.int64, np.int64, np.uint8, np.uint8), start=1))
        order = np.lexsort((b, a))
        a, b, shared, least = a[order], b[order], shared[order].astype(np.int64), least[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        begin = np.flatnonzero(first)
        # A tie of a crowded signature lacks nothing more.
        tied = np.add.reduceat(shared, begin) >= np.minimum.reduceat(least, begin) if len(begin) else first
        a, b = a[begin][tied], b[begin][tied]
        nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
        root = forest(len(nodes), place[: len(a)], place[len(a):])
        some = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.table({"a": pa.array(nodes[root[some]]), "b": pa.array(nodes[some])})

    packed = signatures.groupBy("shard").applyInArrow(tie, "part bigint, a binary, b binary, shared binary, least binary")
    return packed.groupBy("part").applyInArrow(join, "a bigint, b bigint")


def placed_sets(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, node, group, part, parts, task) of every tied set: ``id`` is a document that has it, ``parts`` the blocks of its group.

    Small groups share a task, ``task`` is then its number; the tasks of a large one follow from its parts.
    """
    rows = groups.withColumnRenamed("component", "group").join(sets, "node")
    sizes = rows.groupBy("group").agg(F.sum("n_shingles").alias("size"), F.count("*").alias("n"))
    sizes = kept(sizes.select("group", F.ceil(F.col("size") / BLOCK_ELEMENTS).cast("int").alias("parts"), "size"), "sizes")
    small = sizes.where("parts = 1").agg(F.sum("size")).first()[0] or 0
    task = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("group"), F.lit(max(1, small // BLOCK_ELEMENTS))))
    return rows.join(if_small(sizes.drop("size")), "group").select(
        "id", "node", "group", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "parts", task.alias("task"))


def compare(nodes: np.ndarray, parts: np.ndarray, sets: list[np.ndarray], across: bool, similar: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that connect all similar sets of one task; with ``across`` only sets of different parts are compared."""
    num, den = similar
    sizes = np.array([len(x) for x in sets])
    order = np.lexsort((nodes, sizes))
    nodes, parts, sizes = nodes[order], parts[order], sizes[order]
    ends = np.append(0, np.cumsum(sizes))
    vocabulary, flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    own, mark, found = np.arange(len(nodes)), np.zeros(len(vocabulary), np.uint8), []
    upto = np.searchsorted(sizes, sizes * den // num, "right")
    for x in range(len(nodes)):
        # Only larger sets, as far as their size allows a link.
        other = own[x + 1: upto[x]] != own[x]
        if across:
            other &= parts[x + 1: upto[x]] != parts[x]
        other = np.flatnonzero(other) + x + 1
        if not len(other):
            continue
        mine = flat[ends[x]: ends[x + 1]]
        mark[mine] = 1
        if 2 * len(other) >= upto[x] - x:
            both = np.add.reduceat(mark[flat[ends[x + 1]: ends[upto[x]]]], ends[x + 1: upto[x]] - ends[x + 1], dtype=np.int64)[other - x - 1]
        else:
            starts = np.append(0, np.cumsum(sizes[other]))
            take = np.repeat(ends[other] - starts[:-1], sizes[other]) + np.arange(starts[-1])
            both = np.add.reduceat(mark[flat[take]], starts[:-1], dtype=np.int64)
        mark[mine] = 0
        for y in other[den * both >= num * (sizes[x] + sizes[other] - both)].tolist():
            if own[y] != own[x]:
                found.append((int(nodes[x]), int(nodes[y])))
                own[own == own[y]] = own[x]
    return found


def linked_sets(placed: DataFrame, documents: DataFrame, shingle: int, similar) -> DataFrame:
    """(a, b): links that connect all similar sets of each group."""
    def read(batches):
        sets, sent = Sets(shingle), set()
        for batch in slices(batches):
            rows = {name: [] for name in ("task", "group", "low", "high", "part", "node", "elements")}
            for (node, group, part, parts, task), elements in zip(
                    zip(*(batch.column(n).to_pylist() for n in range(2, 7)), strict=True), sets(batch.column(1)), strict=True):
                # Another text of the same id is another set, and a repeated row is the same one.
                if node in sent or _node(elements) != node:
                    continue
                sent.add(node)
                # Distinct and in order of their low bytes; all sets lose the same bits.
                low = np.unique(elements & np.uint64((1 << 8 * ELEMENT_BYTES) - 1)).astype("<u8").view(np.uint8)
                body = low.reshape(-1, 8)[:, :ELEMENT_BYTES].tobytes()
                for other in range(parts):
                    pair = sorted((part, other))
                    rows["task"].append(task if task is not None else hash((group, *pair)))
                    for name, value in (("group", group), ("low", pair[0]), ("high", pair[1]), ("part", part), ("node", node), ("elements", body)):
                        rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("task", pa.int64()), ("group", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("part", pa.int32()), ("node", pa.int64()), ("elements", pa.binary())]))

    def link(table: pa.Table) -> pa.Table:
        group, low, high, part, node = (table.column(n).to_numpy() for n in range(1, 6))
        bodies, found = table.column("elements"), []
        order = np.lexsort((node, high, low, group))
        keys = np.column_stack((group, low, high))[order]
        cuts = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))), len(order))
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            own = order[begin:end]
            own = own[np.append(True, node[own][1:] != node[own][:-1])]
            sets = []
            for k in own.tolist():
                body = np.frombuffer(bodies[k].as_buffer(), np.uint8).reshape(-1, ELEMENT_BYTES)
                wide = np.zeros((len(body), 8), np.uint8)
                wide[:, :ELEMENT_BYTES] = body
                sets.append(wide.view("<u8")[:, 0])
            found += compare(node[own], part[own], sets, bool(low[own[0]] != high[own[0]]), similar)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    needed = documents.join(if_small(placed), F.col("doc_id") == F.col("id")).select("doc_id", "text", "node", "group", "part", "parts", "task")
    sent = needed.mapInArrow(tidy(read), "task bigint, group bigint, low int, high int, part int, node bigint, elements binary")
    return sent.groupBy("task").applyInArrow(link, "a bigint, b bigint")


def ngram_join(documents: DataFrame, *, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id.

    A document's set holds its distinct runs of ``shingle`` words (A-Z in lower case), or all
    its words if they are fewer. Documents are linked whose sets have a Jaccard similarity of
    at least ``similar``; ``component_id`` is the smallest id that links reach.

    Ids are whole numbers. Every row is returned, repeated rows too: rows with one id are one
    document, linked by the sets of all its texts. A null or empty text has the empty set and is linked with nothing. A row without an
    id is returned with the component null. Other columns are ignored.
    """
    rows = documents.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    context = documents.sparkSession.sparkContext
    table = kept(set_table(rows, shingle), "sets")
    # Rows of documents have a node, rows of frequent shingles do not.
    every = table.where("node IS NOT NULL").select("doc_id", "n_shingles", "node")
    filled = every.where("doc_id IS NOT NULL AND n_shingles > 0")
    frequent = table.where("node IS NULL").groupBy("shingle").agg(F.sum("n_sets").alias("n")).where(F.col("n") >= COMMON_LEAST)
    common = context.broadcast(Common(dict(frequent.orderBy(F.desc("n"), "shingle").limit(COMMON_MOST).collect())))
    sets = kept(filled.groupBy("node").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last"), F.first("n_shingles").alias("n_shingles")), "nodes")
    total, count = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("*")).first()

    named = rows.where("doc_id IS NOT NULL")
    signed = signature_table(named, shingle, similar, common, max(1, -(-total // SHARD_SIGNATURES)))
    groups = kept(components(tied_sets(signed, similar, max(1, count // TIED_SETS))), "groups")
    placed = kept(placed_sets(groups, sets.select("node", "id", "n_shingles")), "placed")
    links = linked_sets(placed, named, shingle, similar)
    # An id with several texts has several sets and ties them.
    several = filled.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("__most")).where("a < __most").select("doc_id", "a")
    tied = filled.join(if_small(kept(several, "several")), "doc_id").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    found = kept(components(links.union(tied)), "components")

    # The smallest id of every set that has others, and of every component.
    named = sets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("component_id"), F.max("last").alias("last")).where("component_id < last")
    names = kept(named.join(if_small(kept(least.drop("last"), "least")), "component").select("node", "component_id"), "names")
    result = every.join(if_small(names), "node", "left")
    return result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
