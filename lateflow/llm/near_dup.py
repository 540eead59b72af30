"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct 5-word shingles (with fewer words, the whole word
sequence). Two permutations of the 64-bit integers give all signature coordinates:
``sigma`` scatters the shingles once, and coordinate k is the minimum of ``pi`` over the
scattered values shifted by k places on the circle of 2^64 values. Coordinates are banded;
documents that agree in a band are candidates, and a link needs the Jaccard similarity of
the full sets to reach the threshold.

Scale. Documents with equal sets (copies) first fold into one representative by a
partially aggregated grouping. A round compares the members of each band bucket with its
pivots: one in the first round, up to ``PIVOTS`` in later ones; the join has a row for each
member, whatever its bucket holds. Members that a confirmed link has put into one component
need no further comparison. Once the remaining pairs between different components are few
against the members, they are compared by one join, which emits those that may still be
links. After a round, members of open buckets get the number of their shingles that any
other open member has, and a sketch of ``SKETCH`` coordinates, which tells pairs apart more
sharply than the signature; members and pairs that these rule out are set aside. So every
pair of a bucket is compared, or already joined through other links, or excluded (set sizes,
shared shingles, and, as in banding, by its signatures and sketches: see Recall); no partner is
capped, and a pair that shares several buckets is emitted in the first. Pairs meet their
texts only if they are not excluded; the texts, which compress where hashes would not, are
shuffled, and the full sets are made of them where they meet. A bucket whose members no
link joins still costs comparisons with the square of its size (of numbers, in a join that
Spark can split), not rows, unless its pairs are close to the threshold.

Recall. A pair at similarity s misses all bands with probability (1 - s^ROWS)^BANDS:
3e-5 at 0.85, 2e-7 at 0.9. Lower thresholds get rows and bands of their own (``banding``), so
that a pair at the threshold misses with 3.1e-5 at most (5 rows, 27 bands at 0.8: 2e-5). That the signature or the sketch of a link agrees in fewer coordinates than
``DEVIATIONS`` standard deviations below the mean is rarer still (6e-7). A shingle is known by a
64-bit hash.

Defined cases: null or blank text has an empty set, links with nothing and is kept. Rows
with a null id take part in no link, have a null component and are kept. Rows that share
an id are one document for linking; each row is returned with its own set size.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateflow.llm.shared import Bloom, U64, arrow_stage, written
from lateflow.llm.words import Words, mix, row_slices, shingles, text_buffer

ROWS = 6
BANDS = 22
#: for lower thresholds: a pair at the threshold misses all bands with this probability at
#: most; coordinates of a signature, as far as one row a band allows
MISSED = 3.1e-5
COORDINATES = 150
WORDS = 5
DEVIATIONS = 5
_C1, _C2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)
_SIGMA = U64(0x2545F4914F6CDD1D)
#: pairs left between components after a comparison with pivots are compared at once when
#: they are no more than this many for each entry of a bucket; else a further round takes
#: this many pivots of each bucket. Both bound a round, not what is compared
PAIRS_PER_MEMBER = 64
PIVOTS = 16
#: coordinates of the sketches by which these pairs are judged
SKETCH = 512


def sets_of_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle hash), distinct, ordered by row and hash."""
    doc, s = shingles(Words(*text_buffer(column)), WORDS)
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (s[1:] != s[:-1])
    return doc[new], s[new]


def signatures(starts: np.ndarray, s: np.ndarray, size: int) -> np.ndarray:
    """[set, coordinate] circulant MinHash of the sets that begin at ``starts`` in s."""
    out = np.empty((len(starts), size), dtype=U64)
    ends = np.append(starts[1:], len(s))
    first = 0
    with np.errstate(over="ignore"):
        while first < len(starts):  # a block of sets that stays in cache
            last = max(int(np.searchsorted(ends, starts[first] + 32768, side="right")),
                       first + 1)
            lo, hi = starts[first], ends[last - 1]
            scattered = mix(s[lo:hi] ^ _SIGMA) * _C1
            at = starts[first:last] - lo
            x, y = np.empty_like(scattered), np.empty_like(scattered)
            for k in range(size):
                np.add(scattered, U64(k) * _C1, out=x)  # shifted by k, then pi
                np.right_shift(x, U64(32), out=y)
                np.bitwise_xor(x, y, out=x)
                np.multiply(x, _C2, out=x)
                out[first:last, k] = np.minimum.reduceat(x, at)
            first = last
    return out


def _profile(rows: int, bands: int):
    """Arrow stage: one row per document with set size, set hash and band keys."""

    def stage(batch: pa.RecordBatch):
        ids, texts = batch.column(0), batch.column(1)
        for a, b in row_slices(texts):
            n = b - a
            doc, s = sets_of_rows(texts.slice(a, n))
            has = np.unique(doc)
            starts = np.searchsorted(doc, has)
            size = np.bincount(doc, minlength=n)
            digest = np.zeros((2, n), dtype=U64)
            keys = np.zeros((n, bands), dtype=U64)
            short = np.zeros((n, rows * bands), dtype=np.int8)
            if len(has):
                with np.errstate(over="ignore"):
                    for i, c in enumerate((U64(0x9AE16A3B2F90404F), U64(0xC3A5C85C97CB3127))):
                        digest[i, has] = np.add.reduceat(mix(s * c + c), starts)
                    sig = signatures(starts, s, rows * bands)
                    short[has] = ((sig * _C1) >> U64(56)).astype(np.uint8).view(np.int8)
                    sig = sig.reshape(len(has), bands, rows)
                    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * _C2,
                                          (len(has), bands)).copy()
                    for r in range(rows):
                        key = mix(key * _C1 + sig[:, :, r])
                keys[has] = key
            lists, coordinates = (pa.ListArray.from_arrays(
                np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.reshape(-1)))
                for x in (keys.view(np.int64), short))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, n), pa.array(size.astype(np.int64)),
                 pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)), lists,
                 coordinates],
                names=["doc_id", "n_shingles", "h1", "h2", "bands", "sig"])

    return stage


def _named(wanted: Bloom, then=None):
    """Arrow stage: the rows whose id the filter holds, or what ``then`` makes of them."""

    def stage(batch: pa.RecordBatch):
        ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).view(U64)
        rows = batch.filter(pa.array(wanted.holds(mix(ids))))
        if then is None:
            yield rows
        elif rows.num_rows:
            yield from then(rows)

    return stage


def sketches(starts: np.ndarray, s: np.ndarray) -> np.ndarray:
    """[set, word] ``SKETCH`` coordinates of each set, of two bits, 32 to a word."""
    out = np.zeros((len(starts), SKETCH // 32), dtype=U64)
    ends = np.append(starts[1:], len(s))
    for a in range(0, len(starts), 256):
        b = min(a + 256, len(starts))
        at = starts[a]
        sig = (signatures(starts[a:b] - at, s[at:ends[b - 1]], SKETCH) * _C1) >> U64(62)
        for i in range(32):
            out[a:b] |= sig[:, i::32] << U64(2 * i)
    return out


def _shingled(batch: pa.RecordBatch):
    """The whole sets of documents, one row for each shingle, and one for the sketch."""
    ids, texts = batch.column(0), batch.column(1)
    for a, b in row_slices(texts):
        doc, s = sets_of_rows(texts.slice(a, b - a))
        mine = ids.slice(a, b - a)
        yield pa.RecordBatch.from_arrays(
            [mine.take(pa.array(doc)), pa.array(s.view(np.int64)),
             pa.nulls(len(s), pa.list_(pa.int64()))], names=["rep", "g", "sketch"])
        has, starts = np.unique(doc, return_index=True)
        words = sketches(starts, s).view(np.int64)
        lists = pa.ListArray.from_arrays(
            np.arange(0, words.size + 1, words.shape[1], dtype=np.int32),
            pa.array(words.reshape(-1)))
        yield pa.RecordBatch.from_arrays(
            [mine.take(pa.array(has)), pa.nulls(len(has), pa.int64()), lists],
            names=["rep", "g", "sketch"])


def _linked(percent: int):
    """Arrow stage: the pairs (a, b) whose texts' full sets reach the threshold."""

    def stage(batch: pa.RecordBatch):
        left, right = batch.column(2), batch.column(3)
        for x, y in row_slices(left):
            n = y - x
            sides = [sets_of_rows(c.slice(x, n)) for c in (left, right)]
            sizes = sum(np.bincount(row, minlength=n) for row, _ in sides)
            row, s = (np.concatenate(c) for c in zip(*sides))
            order = np.lexsort((s, row))
            row, s = row[order], s[order]
            both = np.flatnonzero((row[1:] == row[:-1]) & (s[1:] == s[:-1]))
            common = np.bincount(row[both], minlength=n)
            near = pa.array(common * 100 >= (sizes - common) * percent)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(x, n).filter(near) for i in (0, 1)], names=["a", "b"])

    return stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the undirected edges (a, b); the component is its smallest
    node. Each round hooks every node to the first of itself and its neighbours, by degree
    and then in a hashed order, and contracts: a star at once, a path by a constant factor."""
    edges = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    label, round_ = None, 0
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("k"))

        def rank(c, k):
            return F.struct((-F.col(k)).alias("k"), F.xxhash64(F.lit(round_), c).alias("o"),
                            F.col(c).alias("v"))

        near = both.join(degree.select(F.col("a").alias("b"), F.col("k").alias("kb")), "b")
        hook = (near.groupBy("a").agg(F.min(rank("b", "kb")).alias("m"),
                                      F.count(F.lit(1)).alias("k"))
                .select("a", F.least(F.col("m"), rank("a", "k"))["v"].alias("to")))
        hook = written(hook, "hook")
        step = hook.select(F.col("a").alias("comp"), "to")
        if label is None:
            label = hook.select(F.col("a").alias("node"), F.col("to").alias("comp"))
        else:
            label = written(label.join(step, "comp", "left")
                            .select("node", F.coalesce("to", "comp").alias("comp")), "label")
        ends = edges.join(hook.select("a", F.col("to").alias("ta")), "a").join(
            hook.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b")
        edges = written(ends.filter("ta <> tb").select(
            F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        round_ += 1
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    least = label.groupBy("comp").agg(F.min("node").alias("component"))
    return label.join(least, "comp").select("node", "component")


def banding(percent: int) -> tuple[int, int]:
    """Rows and bands for a threshold: the most rows whose bands reach ``MISSED``."""
    if percent >= 85:
        return ROWS, BANDS
    for rows in range(ROWS, 0, -1):
        bands = math.ceil(math.log(MISSED) / math.log1p(-(percent / 100) ** rows))
        if rows * bands <= COORDINATES:
            break
    return rows, bands


def near_duplicates(docs: DataFrame, threshold: float = 0.85, rows: int | None = None,
                    bands: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept
    (doc_id is its component's), for each row of ``docs`` (doc_id long, text string).
    The threshold is taken in whole hundredths, so links are decided in integers."""
    percent = round(threshold * 100)
    fit = banding(percent)
    rows, bands = rows or fit[0], bands or fit[1]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    profile = written(arrow_stage(
        docs, _profile(rows, bands),
        "doc_id long, n_shingles long, h1 long, h2 long, bands array<long>, sig array<tinyint>"),
        "profile")
    full = profile.filter("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    reps = written(classes, "reps")
    comp, links = _links(docs, reps, percent, rows * bands)
    # rows that share an id but not a text are one document
    more = [x for x in (links, _shared_ids(full, reps)) if x is not None]
    label = joined(comp, reduce(DataFrame.union, more, reps.select(
        F.col("rep").alias("a"), F.col("rep").alias("b")).limit(0)))
    found = reps.select("h1", "h2", F.col("rep").alias("node")).join(label, "node", "left")
    found = found.select("h1", "h2", F.coalesce("component", "node").alias("component_id"))
    # several classes may meet in one id only, so each (h1, h2) has exactly one component
    out = profile.select("doc_id", "n_shingles", "h1", "h2").join(found, ["h1", "h2"], "left")
    own = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(own, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def joined(comp: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The components ``comp`` (node, component), as further edges join them: only these
    are followed, between components that are known already."""
    if comp is None:
        return components(edges)
    edges = written(edges, "further")
    if edges.isEmpty():
        return comp
    for c in "ab":
        edges = edges.join(comp.select(F.col("node").alias(c), F.col("component").alias("c")), c,
                           "left").withColumn(c, F.coalesce("c", c)).drop("c")
    more = written(components(edges), "more")
    old = comp.join(more.select(F.col("node").alias("component"), F.col("component").alias("to")),
                    "component", "left").select("node", F.coalesce("to", "component").alias(
                        "component"))
    return written(old.union(more.join(comp, "node", "left_anti")), "comp")


def _shared_ids(full: DataFrame, reps: DataFrame) -> DataFrame | None:
    """Links between the classes in which one id occurs, as (a, b) of representatives; None
    if no id occurs in two."""
    key = F.struct("h1", "h2")
    several = written(full.groupBy("doc_id").agg(F.min(key).alias("m"), F.max(key).alias(
        "x")).filter("m <> x").select("doc_id", "m"), "several")
    if several.isEmpty():
        return None
    links = several.join(full, "doc_id").select("m", "h1", "h2").distinct()
    side = reps.select("h1", "h2", F.col("rep").alias("b"))
    first = reps.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("rep").alias("a"))
    return (links.join(side, ["h1", "h2"])
            .join(first, (F.col("m.h1") == F.col("g1")) & (F.col("m.h2") == F.col("g2")))
            .select("a", "b"))


def _able(x: str, y: str, percent: int) -> str:
    """SQL condition: x and y are in different components, and neither their set sizes nor
    the shingles that others share with them rule a link out."""
    both = f"least({x}.s, {y}.s)"
    return (f"{x}.c <> {y}.c and least({x}.n, {y}.n) * 100 >= greatest({x}.n, {y}.n) * {percent} "
            f"and {both} * 100 >= ({x}.n + {y}.n - {both}) * {percent}")


def _least_agreeing(size: int, share: float) -> float:
    return size * share - DEVIATIONS * math.sqrt(size * share * (1 - share))


def _likely(x: str, y: str, percent: int, size: int) -> str:
    """SQL condition: the signatures agree as often as a link's would."""
    return (f"aggregate(zip_with({x}.sig, {y}.sig, (p, q) -> if(p = q, 1, 0)), 0, "
            f"(p, q) -> p + q) >= {_least_agreeing(size, percent / 100)!r}D")


def _likely_by_sketch(x: str, y: str, percent: int) -> str:
    """The same of the sketches, whose coordinates also agree by chance, one in four. Of each
    two bits that differ at all, the lower is counted."""
    share = percent / 100
    return (f"aggregate(zip_with({x}.sketch, {y}.sketch, (p, q) -> p ^ q), 0, (t, d) -> t + "
            f"bit_count((d | shiftrightunsigned(d, 1)) & {0x5555555555555555}L)) <= "
            f"{SKETCH - _least_agreeing(SKETCH, share + (1 - share) / 4)!r}D")


def _links(docs: DataFrame, reps: DataFrame, percent: int, size: int):
    """(components, links): confirmed links that connect whatever the candidate pairs
    connect; those found by pivots are followed already, as components (None: none)."""
    entry = reps.select("rep", "h1", F.explode("bands").alias("key"))
    shared = entry.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    # the pivot of a bucket is the member that meets most others over all its bands:
    # among edited copies of one text, the text itself
    members = entry.join(shared, "key").groupBy("rep", "h1").agg(
        F.sum("m").alias("weight"), F.collect_list("key").alias("keys"))
    state = written(members.join(reps.select("rep", "h1", "n", "sig"), ["rep", "h1"]).select(
        F.explode("keys").alias("key"), "rep", "h1", "n", "weight", F.col("n").alias("s"), "sig"),
        "members")
    entries = state.count()
    docs = docs.filter("doc_id is not null").select(F.col("doc_id").alias("rep"), "text")
    comp, rounds, grown = None, 0, True
    while True:
        if comp is not None:
            label = comp.select(F.col("node").alias("rep"), F.col("component").alias("c"))
            state = state.join(label, "rep", "left").withColumn("c", F.coalesce("c", "rep"))
        else:
            state = state.withColumn("c", F.col("rep"))
        if rounds and grown:  # what a comparison with pivots has left over
            state = written(_still_open(state), "open")
            if state.isEmpty():
                return comp, None
            state, sketch = _with_shared(state, docs, percent)
        buckets = written(_buckets(state, PIVOTS if rounds else 1), "buckets")
        left = buckets.agg(F.sum("left")).first()[0]
        if not left:
            return comp, None
        state = state.join(buckets.select("key", "pivots"), "key")
        if rounds and left <= PAIRS_PER_MEMBER * entries:
            wide = state.drop("pivots", "sig", "weight").join(
                reps.select("rep", "h1", "bands"), ["rep", "h1"]).join(sketch, "rep")
            x, y = wide.alias("x"), wide.alias("y")
            # a pair in several buckets is emitted in its first; if a member has left that
            # one, the pair was compared with a pivot there, or proved to be no link
            near = x.join(y, F.expr(
                f"x.key = y.key and x.rep < y.rep and {_able('x', 'y', percent)} and "
                f"{_likely_by_sketch('x', 'y', percent)} and x.key = filter(x.bands, (k, i) -> k = y.bands[i])[0]"))
            near = near.selectExpr("x.rep as a", "y.rep as b")
            return comp, written(_confirmed(near, docs, percent), "links")
        # the pivots meet all members of their buckets, a row for each member
        own = "named_struct('c', c, 'n', n, 's', s, 'sig', sig)"
        able = f"{_able('x', 'y', percent)} and {_likely('x', 'y', percent, size)}"
        met = f"filter(pivots, y -> exists(array({own}), x -> {able}))"
        state = written(state.selectExpr(
            "key", "rep", "h1", "n", "weight", "s", "sig", f"transform({met}, y -> y.rep) as met",
            "exists(pivots, y -> y.rep = rep and y.h1 = h1) as pivot"), "met")
        near = state.select("rep", F.explode("met").alias("other")).selectExpr(
            "least(rep, other) as a", "greatest(rep, other) as b")
        links = written(_confirmed(near, docs, percent), "links")
        found = not links.isEmpty()
        if found:
            comp = written(joined(comp, links), "comp")
        state = state.filter("not pivot").drop("met", "pivot")
        grown, rounds = found or not rounds, rounds + 1


def _buckets(state: DataFrame, pivots: int) -> DataFrame:
    """Buckets with members of different components: their number of such pairs, and up to
    ``pivots`` of their members, each the heaviest of a part of them."""
    best = F.max(F.struct("weight", (-F.col("rep")).alias("minus"), "rep", "h1", "c", "n", "s",
                            "sig"))
    part = F.pmod(F.xxhash64("rep"), F.lit(pivots)) if pivots > 1 else F.lit(0)
    per_comp = state.groupBy("key", "c", part.alias("part")).agg(
        F.count(F.lit(1)).alias("k"), best.alias("p"))
    if pivots > 1:  # a component's pairs are counted over its parts
        per_part = per_comp.groupBy("key", "part").agg(F.max("p").alias("p"))
        heads = per_part.groupBy("key").agg(F.collect_list("p").alias("pivots"))
        sizes = per_comp.groupBy("key", "c").agg(F.sum("k").alias("k"))
        return _left(sizes).join(heads, "key")
    return _left(per_comp, F.array(F.max("p")).alias("pivots"))


def _left(per_comp: DataFrame, *more) -> DataFrame:
    """Buckets (key) with members of different components, and their number of such pairs."""
    return per_comp.groupBy("key").agg(
        ((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("left"),
        *more).filter("left > 0")


def _still_open(state: DataFrame) -> DataFrame:
    keys = state.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"),
                                    F.min("n").alias("least")).filter("lo <> hi")
    return state.join(keys.select("key", "least"), "key")


def _with_shared(state: DataFrame, docs: DataFrame, percent: int):
    """(state, sketches of its members). Sets s to the number of a member's shingles that any
    other member of an open bucket has, and drops the members that this proves to have no
    link: the intersection with any partner is at most s, the union at least n + (smallest
    possible partner) - s."""
    own = written(_of(docs, state.select("rep"), _shingled,
                      "rep long, g long, sketch array<long>"), "shingles")
    named = own.filter("g is not null").select("rep", "g")
    common = named.groupBy("g").agg(F.min("rep").alias("one"), F.max("rep").alias("two")).filter(
        "one <> two").select("g")
    s = named.join(common, "g", "left_semi").groupBy("rep").agg(F.count(F.lit(1)).alias("s"))
    out = state.drop("s").join(s, "rep", "left").fillna(0, ["s"])
    partner = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    out = out.filter(F.col("s") * 100 >= (F.col("n") + partner - F.col("s")) * percent).drop(
        "least")
    return written(out, "state"), own.filter("g is null").select("rep", "sketch")


def _hashed_ids(ids: DataFrame) -> DataFrame:
    def stage(batch):
        h = mix(batch.column(0).to_numpy().view(U64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h)], names=["h"])
    return arrow_stage(ids, stage, "h long")


def _of(docs: DataFrame, ids: DataFrame, then=None,
        schema: str = "rep long, text string") -> DataFrame:
    """The rows (rep, text) of the documents named in ``ids`` (rep), and a few others: a
    filter of fixed size keeps most other texts out of the shuffle. ``then`` is an Arrow
    stage on these rows; in the same one, as two in a row need two Python workers for each
    core, and executors keep every worker that they once had."""
    wanted = Bloom.build(_hashed_ids(ids.distinct()), "h")
    return arrow_stage(docs, _named(wanted, then), schema)


def _confirmed(near: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    near = written(near.distinct(), "near")
    texts = _of(docs, near.select(F.explode(F.array("a", "b")).alias("rep")))
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    both = near.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return arrow_stage(both, _linked(percent), "a long, b long")
