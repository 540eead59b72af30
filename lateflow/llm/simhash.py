"""Near duplicates by SimHash fingerprints, found with pigeonring filtering.

A text's 3-word shingles (lower-cased words joined by a space, repeats included) are hashed
with XXH64; bit b of the fingerprint is set if it is set in over half of the hashes. Two
fingerprints link if they differ in at most ``distance`` bits.

Pigeonring. The 64 bits are cut into ``distance`` + 1 consecutive segments on a ring. If two
fingerprints differ in at most ``distance`` bits, there is a segment from which every chain
of l consecutive segments differs in at most l * distance / (distance + 1) bits, rounded
down: in none for the first, in at most one for two segments, two for three, and so on (Qin
and Xiao, 2018). The first budget and the second make the search key: the start segment as it
is, and the next one cut into ``PIECES`` pieces, of which all but one are as they are. For
3 bits these are 16 keys of 28 bits. Fingerprints that meet in a key are compared chain by
chain; only those within every budget get the full Hamming check. Nothing is lost: a pair
within the distance meets in the key of its viable chain.

Scale. Equal fingerprints fold into one by a partially aggregated grouping, so copies never
meet as rows. Keys are counted first, so only keys that several fingerprints share are
shuffled with their members, and a key of more than ``BLOCK`` members is cut into blocks by a
hash; each pair of blocks is a group of its own. A group never emits its pairs: small ones
emit confirmed links (each pair in its first viable key only), larger ones a spanning
forest, found by comparing one member after the other with the members not yet reached. The
forest has the same components as all links of the group together.

Defined cases: a text without words, or null, has fingerprint zero and links like any other.
A row without an id gets its fingerprint, takes part in no link, has a null component and is
kept. Rows are documents of their own even if they repeat an id; a component's id is the
smallest id in it. Extra columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateflow.llm.near_dup import components
from lateflow.llm.shared import U64, arrow_stage, written
from lateflow.llm.words import row_slices, text_buffer

BITS = 64
WORDS = 3
SEED = 42
PIECES = 4
BLOCK = 4096
#: groups up to this size emit their links, larger ones a spanning forest
SMALL = 16
#: bytes of one text that are split into words at a time, and of texts in one slice
CHUNK = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ONES = U64(0x0101010101010101)


def _word_blocks(raw: bytes):
    """The lower-case words of a text, a list for each CHUNK of it (cut at white space)."""
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + CHUNK) if at + CHUNK < len(raw) else None
        end = cut.start() if cut else len(raw)
        yield raw[at:end].lower().split()  # bytes: A-Z and the six ASCII spaces only
        at = end


def shingle_hashes(raw: bytes) -> np.ndarray:
    """XXH64 of every 3-word shingle of a text, in order; with fewer words, of all of them."""
    out, held = [], []
    for words in _word_blocks(raw):
        held += words
        if len(held) >= WORDS:
            joined = map(b" ".join, zip(held, held[1:], held[2:]))
            out.append(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), U64,
                                   len(held) - WORDS + 1))
            held = held[1 - WORDS:]
    if not out and held:
        out.append(np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], U64))
    return np.concatenate(out) if out else np.zeros(0, U64)


def fingerprints(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint for each text's hashes; zero for none."""
    count = np.array([len(h) for h in hashes], dtype=np.int64)
    out = np.zeros(len(hashes), dtype=U64)
    some = np.flatnonzero(count)
    if not len(some):
        return out
    h = np.concatenate([hashes[i] for i in some])
    # counts of up to 255 hashes fit in the bytes of one word: add eight bits at a time
    runs = -(-count[some] // 255)
    first = np.cumsum(runs) - runs
    begin = np.cumsum(count[some]) - count[some]
    inside = np.arange(runs.sum()) - np.repeat(first, runs)
    starts = np.repeat(begin, runs) + 255 * inside
    votes = np.empty((len(starts), BITS), dtype=np.int64)
    for k in range(8):
        ones = (h >> U64(k)) & _ONES
        votes[:, k::8] = np.add.reduceat(ones, starts).view(np.uint8).reshape(-1, 8)
    votes = np.add.reduceat(votes, first, axis=0)
    set_ = 2 * votes > count[some][:, None]
    out[some] = np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()
    return out


def _profile(batch: pa.RecordBatch):
    ids, texts = batch.column(0), batch.column(1)
    for a, b in row_slices(texts, CHUNK):
        raw, at = text_buffer(texts.slice(a, b - a))
        found = fingerprints([shingle_hashes(raw[x:y].tobytes())
                              for x, y in zip(at[:-1].tolist(), at[1:].tolist())])
        yield pa.RecordBatch.from_arrays(
            [ids.slice(a, b - a), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


class Ring:
    """Segments, chain budgets and key masks for a distance."""

    def __init__(self, distance: int, pieces: int = PIECES):
        if not 1 <= distance < BITS // (2 * pieces):
            raise ValueError(f"distance {distance} is not supported")
        self.distance, self.size = distance, distance + 1
        edges = [BITS * i // self.size for i in range(self.size + 1)]
        self.segments = [self._mask(a, b) for a, b in zip(edges, edges[1:])]
        self.budgets = [length * distance // self.size for length in range(self.size + 1)]
        #: (start segment, bits that members of a key agree in)
        self.keys = []
        for i in range(self.size):
            lo = edges[(i + 1) % self.size]
            width = edges[(i + 1) % self.size + 1] - lo
            for q in range(pieces):
                free = self._mask(lo + width * q // pieces, lo + width * (q + 1) // pieces)
                self.keys.append((i, (self.segments[i] | self.segments[(i + 1) % self.size])
                                  & ~free))
        self.starts = np.array([i for i, _ in self.keys])

    @staticmethod
    def _mask(a: int, b: int) -> int:
        return (1 << b) - (1 << a)

    def viable(self, x: np.ndarray, start: int) -> np.ndarray:
        """Positions of differences ``x`` whose chains from ``start`` stay within all
        budgets; the last chain is the whole ring, so they are within the distance."""
        left = np.arange(len(x))
        mask = 0
        for length in range(1, self.size + 1):
            mask |= self.segments[(start + length - 1) % self.size]
            fine = np.bitwise_count(x[left] & U64(mask)) <= self.budgets[length]
            left = left[fine]
        return left

    def first_key(self, x: np.ndarray) -> np.ndarray:
        """Number of the first key in which each (linking) difference is viable."""
        out = np.full(len(x), len(self.keys))
        for number in reversed(range(len(self.keys))):
            start, mask = self.keys[number]
            alike = np.flatnonzero((x & U64(mask)) == 0)
            out[alike[self.viable(x[alike], start)]] = number
        return out


def _forest(fp: np.ndarray, ring: Ring, start: int):
    """Edges of a spanning forest of the links within one group."""
    unreached = fp
    edges = []
    while len(unreached):
        queue, unreached = [unreached[0]], unreached[1:]
        while queue and len(unreached):
            pivot = queue.pop()
            near = ring.viable(unreached ^ pivot, start)
            if len(near):
                found = unreached[near]
                edges.append(np.column_stack((np.full(len(found), pivot), found)))
                queue.extend(found)
                unreached = np.delete(unreached, near)
    return np.concatenate(edges) if edges else np.zeros((0, 2), U64)


def _group_links(key: np.ndarray, group: np.ndarray, fp: np.ndarray, ring: Ring):
    """Edges within the groups of rows (equal key number and group start)."""
    new = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(new, len(fp)))
    out = []
    few = np.repeat(size <= SMALL, size)
    for lag in range(1, min(SMALL, int(size.max()))):
        a = np.flatnonzero(few[:-lag] & (group[lag:] == group[:-lag]))
        if not len(a):
            break
        x = fp[a] ^ fp[a + lag]
        for start in range(ring.size):
            own = np.flatnonzero(ring.starts[key[a]] == start)
            own = own[ring.viable(x[own], start)]
            own = own[ring.first_key(x[own]) == key[a[own]]]
            out.append(np.column_stack((fp[a[own]], fp[a[own] + lag])))
    for i in np.flatnonzero(size > SMALL):
        rows = slice(new[i], new[i] + size[i])
        out.append(_forest(fp[rows], ring, ring.starts[key[new[i]]]))
    return np.concatenate(out) if out else np.zeros((0, 2), U64)


def _linker(ring: Ring):
    """Arrow function over rows (number, masked, lo, hi, fp) sorted by group: links. A
    group may reach over batches; its rows (at most two blocks of a key) are held back."""

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            rows = rows if held is None else [np.concatenate(p) for p in zip(held, rows)]
            other = [c[1:] != c[:-1] for c in rows[:4]]
            starts = np.flatnonzero(np.append(True, np.logical_or.reduce(other)))
            group = np.repeat(np.arange(len(starts)),
                              np.diff(np.append(starts, len(rows[0]))))
            last = starts[-1]
            held = [c[last:] for c in rows]
            if last:
                yield _edges([c[:last] for c in rows], group[:last])
        if held is not None:
            yield _edges(held, np.zeros(len(held[0]), dtype=np.int64))

    def _edges(rows, group):
        found = _group_links(rows[0].astype(np.int64), group, rows[4].view(U64), ring)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(found[:, i]).view(np.int64)) for i in (0, 1)],
            names=["a", "b"])

    return run


def links(fps: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect whatever the
    pairs within ``distance`` connect."""
    ring = Ring(distance)

    def signed(mask):
        return mask - (1 << BITS) if mask >> (BITS - 1) else mask

    keys = F.array(*[F.struct(F.lit(n).cast("byte").alias("number"),
                              F.col("fp").bitwiseAND(F.lit(signed(mask)).cast("long"))
                              .alias("masked")) for n, (_, mask) in enumerate(ring.keys)])
    entries = fps.select("fp", F.explode(keys).alias("k")).select("k.*", "fp")
    # counted before the members move: a hot key is one row for each task here
    shared = written(entries.groupBy("number", "masked").agg(
        F.count(F.lit(1)).alias("m")).filter("m > 1"), "keys")
    blocks = F.ceil(F.col("m") / block)
    own = F.pmod(F.xxhash64("fp"), blocks)
    members = entries.join(shared, ["number", "masked"]).withColumn("own", own).select(
        "number", "masked", "own", "fp",
        F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other"))
    group = ["number", "masked", "lo", "hi"]
    members = members.select(
        "number", "masked", F.least("own", "other").alias("lo"),
        F.greatest("own", "other").alias("hi"), "fp")
    dealt = members.repartition(*group).sortWithinPartitions(*group, "fp")
    return dealt.mapInArrow(_linker(ring), "a long, b long")


def simhash_duplicates(docs: DataFrame, distance: int = 3, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits), component_id (smallest id reachable
    over links) and kept (doc_id is its component's) of each row of ``docs`` (doc_id,
    text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    profile = written(arrow_stage(docs, _profile, "doc_id long, fp long"), "simhash")
    reps = written(profile.filter("doc_id is not null").groupBy("fp").agg(
        F.min("doc_id").alias("rep")), "fingerprints")
    label = components(links(reps.select("fp"), distance, block))
    both = reps.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = both.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = written(both.join(least, "component").select("fp", "component_id"), "components")
    out = profile.join(found, "fp", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
