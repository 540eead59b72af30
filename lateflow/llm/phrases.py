"""Phrase collocations by Rabin-Karp fingerprints of n-grams.

Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line breaks, and those
into words at spaces and tabs; all counts are per language. Prefix polynomials over the bytes
give each word a hash, prefix polynomials over the word hashes give one to every n-gram of a
piece, by array operations only. A slice of texts counts its distinct fingerprints, and a
partially aggregated grouping by fingerprint adds the counts, with the pointer (document and
byte) of one occurrence. Only fingerprints with ``LEAST`` occurrences or more stay.

A phrase cannot be more frequent than its parts. So n-grams are counted by length, and from
three words on only those whose two (n-1)-grams may be frequent leave the scan, by a Bloom
filter of fixed size; the counts behind it are exact.

Collisions. A second, independent 32-bit polynomial of the occurrence travels with its
fingerprint as a minimum and a maximum. Where they differ, different texts share the
fingerprint: these occurrences are counted again by their text. Then one text is
materialised for every frequent phrase, from the document its pointer names, and has to give
the fingerprint again; nothing else is ever turned into text.

A candidate of two to ``LONGEST`` words has the score floor(10^6 a^2 / (l r)) of the cut that
scores lowest, a, l and r being the frequencies of phrase, left and right part (in decimals
of 38 digits, as products pass 64 bits). It is dropped if a longer candidate that contains it
has at least ``COVERED`` hundredths of its frequency.

Scale. The distinct n-grams of each slice are shuffled once for each length, as numbers.
Frequent words are added up before they are shuffled; the join of phrases with the counts of
their parts is over frequent phrases only, and its hot words are split by the adaptive skew
join. The best ``TOP`` of a language are taken in each task first. Texts are shuffled only
where a pointer names them.

Defined cases: a null or empty text has no words; a null language counts as ``und``, like the
text ``und`` itself. Repeated rows count each. Very long texts are handled a part at a time
(cut between pieces). Ties of the score go to the more frequent, then to the phrase that comes
first in UTF-8 order. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateflow.llm.shared import Bloom, U64, arrow_stage, keeps, written
from lateflow.llm.words import mix, row_slices, text_buffer

LEAST = 10
LONGEST = 3
COVERED = 50
TOP = 2000
UNKNOWN = "und"
#: bytes of text handled at a time
SLICE = 1 << 20
_STEPS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True
_BYTE = [mix(np.arange(1, 257, dtype=U64) * U64(s)) for s in _STEPS]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = keeps({})


def _power_tables(step: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of an odd step and of its inverse, modulo 2^64."""
    if step not in _powers or len(_powers[step][0]) <= n:
        tables = tuple(np.cumprod(np.concatenate(([U64(1)], np.full(
            max(n, SLICE), U64(b), U64))), dtype=U64) for b in (step, pow(step, -1, 1 << 64)))
        if n > 2 * SLICE:  # one very long piece: not kept
            return tables
        _powers[step] = tables
    return _powers[step]


def range_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray, step: int):
    """The polynomial of values[first:last] in ``step``, for each range, from prefix sums."""
    up, down = _power_tables(step, len(values))
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * up[:len(values)], out=total[1:])
        return (total[last] - total[first]) * down[first]


class Pieces:
    """Words of a slice of texts: row, start, end (bytes), piece, and both word hashes."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.lower = _LOWER[raw]
        gap = np.append(_GAP[raw], True)
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[offsets] = True
        before = np.append(True, gap[:-1]) | edge
        self.start = np.flatnonzero(~gap & before)
        self.end = np.flatnonzero(~gap[:-1] & (gap[1:] | edge[1:])) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.piece = np.cumsum(_BREAK[raw])[self.start]
        self.hashes = []
        with np.errstate(over="ignore"):
            size = (self.end - self.start).astype(U64)
            for step, byte in zip(_STEPS, _BYTE):
                h = range_hashes(byte[self.lower], self.start, self.end, step)
                self.hashes.append(mix(h + size * U64(step)))

    def ngrams(self, n: int, seeds: np.ndarray, bits: int):
        """(first word, fingerprint, check) of every n-gram; ``seeds`` has one number for
        each row's language."""
        many = max(len(self.start) - n + 1, 0)
        first = np.arange(many)
        whole = ((self.row[:many] == self.row[n - 1:])
                 & (self.piece[:many] == self.piece[n - 1:])) if many else first > 0
        first = first[whole]
        seed = seeds[self.row[first]]
        with np.errstate(over="ignore"):
            h, c = (mix(range_hashes(w, first, first + n, step) * U64(2 * n + 1) ^ seed)
                    for w, step in zip(self.hashes, _STEPS))
        if bits < 64:
            h &= U64((1 << bits) - 1)
        return first, h, (c >> U64(32)).astype(np.uint32).view(np.int32)

    def text(self, i: int, n: int) -> bytes:
        return b" ".join(self.lower[a:b].tobytes() for a, b in zip(
            self.start[i:i + n].tolist(), self.end[i:i + n].tolist()))


def parts(texts: pa.Array, size: int = SLICE):
    """(bytes, offsets, rows, first bytes) of slices of about ``size`` bytes; a longer text
    is cut between pieces."""
    for a, b in row_slices(texts, size):
        raw, at = text_buffer(texts.slice(a, b - a))
        if b - a > 1 or len(raw) <= 2 * size:
            yield raw, at, np.arange(a, b), np.zeros(b - a, dtype=np.int64)
            continue
        here = 0
        while here < len(raw):
            end = here + size
            while end < len(raw):
                found = np.flatnonzero(_BREAK[raw[end:end + size]])
                end += found[0] if len(found) else size
                if len(found):
                    break
            end = min(end, len(raw))
            yield (raw[here:end], np.array([0, end - here]), np.array([a]), np.array([here]))
            here = end


def _seeds(langs: pa.Array) -> np.ndarray:
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
             for x in langs.unique().to_pylist()}
    return np.array([known[x] for x in langs.to_pylist()], dtype=U64)


def _counting(lengths: list[int], shorter: Bloom | None, bits: int):
    """Arrow stage: distinct n-grams of a slice with count, least and greatest check and the
    pointer of the first; n = 0 has the words of each language, under its seed."""

    def stage(batch: pa.RecordBatch):
        key = batch.column(0).to_numpy().view(U64) >> U64(32) << U64(32)
        seeds = _seeds(batch.column(1))
        for raw, at, rows, base in parts(batch.column(2)):
            p = Pieces(raw, at)
            found = []
            if 1 in lengths:
                lang, where = np.unique(seeds[rows], return_inverse=True)
                n = np.bincount(where, np.bincount(p.row, minlength=len(rows)), len(lang))
                zero = np.zeros(len(lang), dtype=np.int32)
                found.append((0, lang, n.astype(np.int64), zero, zero, lang))
            for n in lengths:
                first, h, check = p.ngrams(n, seeds[rows], bits)
                if shorter is not None:
                    lead, f, _ = p.ngrams(n - 1, seeds[rows], bits)
                    may = np.zeros(len(p.start) + 1, dtype=bool)
                    may[lead[shorter.holds(f)]] = True
                    some = may[first] & may[first + 1]
                    first, h, check = first[some], h[some], check[some]
                if not len(h):
                    continue
                order = np.argsort(h, kind="stable")
                h, check = h[order], check[order]
                new = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                one = first[order[new]]
                row = p.row[one]
                spot = (p.start[one] - at[row] + base[row]).astype(U64)
                found.append((n, h[new], np.diff(np.append(new, len(h))),
                              np.minimum.reduceat(check, new), np.maximum.reduceat(check, new),
                              key[rows[row]] | spot))
            for n, h, c, lo, hi, ptr in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), n, np.int8)), pa.array(h.view(np.int64)),
                     pa.array(c), pa.array(lo), pa.array(hi), pa.array(ptr.view(np.int64))],
                    names=["n", "fp", "c", "lo", "hi", "ptr"])

    return stage


def _counts(docs: DataFrame, lengths: list[int], shorter: Bloom | None, least: int,
            bits: int) -> DataFrame:
    """n, fp, c, lo, hi, ptr of the fingerprints with ``least`` occurrences or more."""
    found = arrow_stage(docs, _counting(lengths, shorter, bits),
                        "n byte, fp long, c long, lo int, hi int, ptr long")
    # two columns of numbers as key, numbers as values: one hash aggregate before the shuffle
    return written(found.groupBy("n", "fp").agg(
        F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("ptr").alias("ptr")).filter(f"n = 0 or c >= {least}"), "ngrams")


def _recounted(docs: DataFrame, mixed: DataFrame, least: int, longest: int,
               bits: int) -> DataFrame:
    """n, fp, check, c, ptr of the texts behind fingerprints that several texts share,
    counted by text."""
    wanted = Bloom.build(mixed.select("fp"), "fp", 1 << 24)

    def stage(batch: pa.RecordBatch):
        key = batch.column(0).to_numpy().view(U64) >> U64(32) << U64(32)
        seeds = _seeds(batch.column(1))
        for raw, at, rows, base in parts(batch.column(2)):
            p = Pieces(raw, at)
            for n in range(1, longest + 1):
                first, h, check = p.ngrams(n, seeds[rows], bits)
                some = np.flatnonzero(wanted.holds(h))
                row = p.row[first[some]]
                spot = (p.start[first[some]] - at[row] + base[row]).astype(U64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), n, np.int8)), pa.array(h[some].view(np.int64)),
                     pa.array(check[some]), batch.column(1).take(pa.array(rows[row])),
                     pa.array([p.text(i, n).decode() for i in first[some].tolist()], pa.string()),
                     pa.array((key[rows[row]] | spot).view(np.int64))],
                    names=["n", "fp", "check", "lang", "phrase", "ptr"])

    found = arrow_stage(docs, stage,
                        "n byte, fp long, check int, lang string, phrase string, ptr long")
    found = found.join(mixed.select("n", "fp"), ["n", "fp"], "left_semi")
    return written(found.groupBy("n", "fp", "check", "lang", "phrase").agg(
        F.count(F.lit(1)).alias("c"), F.min("ptr").alias("ptr")).filter(
            f"c >= {least}").select("n", "fp", "check", "c", "ptr"), "recounted")


_PART = "struct<fp:long,check:int>"
_MADE = (f"n byte, fp long, check int, seed long, lang string, phrase string, left array<{_PART}>, "
         f"right array<{_PART}>, inner array<{_PART}>")


def _materialised(docs: DataFrame, frequent: DataFrame, longest: int, bits: int) -> DataFrame:
    """The text of each frequent phrase of two words or more, with the fingerprints of the
    parts of each cut (left, right) and of the shorter phrases inside."""
    half = F.shiftrightunsigned("ptr", 32)
    asked = written(frequent.filter("n > 1").groupBy(half.alias("half")).agg(F.collect_list(
        F.struct("n", "fp", "check", F.col("ptr").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"))
    ).alias("asked")), "pointers")  # at most the n-grams of a document
    wanted = Bloom.build(asked.select("half"), "half", 1 << 25)

    def named(batch: pa.RecordBatch):
        at = batch.column(0).to_numpy().view(U64) >> U64(32)
        some = pa.array(wanted.holds(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.view(np.int64)), batch.column(1), batch.column(2)],
            names=["half", "lang", "text"]).filter(some)

    def stage(batch: pa.RecordBatch):
        seeds, langs = _seeds(batch.column(0)), batch.column(0).to_pylist()
        lists = batch.column(2).to_pylist()
        for raw, at, rows, base in parts(batch.column(1)):
            p = Pieces(raw, at)
            grams = {}
            for n in range(1, longest + 1):
                first, h, check = p.ngrams(n, seeds[rows], bits)
                table = np.zeros((2, len(p.start)), dtype=np.int64)
                table[0, first], table[1, first] = h.view(np.int64), check
                whole = np.zeros(len(p.start), dtype=bool)
                whole[first] = True
                grams[n] = table, whole

            def part(n, i):
                return {"fp": int(grams[n][0][0, i]), "check": int(grams[n][0][1, i])}

            out = []
            for j, row in enumerate(rows.tolist()):
                for a in lists[row]:
                    n = a["n"]
                    spot = a["at"] - int(base[j]) + int(at[j])
                    i = int(np.searchsorted(p.start, spot))
                    # another document may share the pointer's half: the text has to agree
                    if not (at[j] <= spot < at[j + 1] and i < len(p.start)
                            and p.start[i] == spot and grams[n][1][i]
                            and part(n, i) == {"fp": a["fp"], "check": a["check"]}):
                        continue
                    out.append({
                        "n": n, "fp": a["fp"], "check": a["check"],
                        "seed": int(seeds[row].astype(np.int64)), "lang": langs[row],
                        "phrase": p.text(i, n).decode(),
                        "left": [part(k, i) for k in range(1, n)],
                        "right": [part(n - k, i + k) for k in range(1, n)],
                        "inner": [part(m, i + k) for m in range(2, n)
                                  for k in range(n - m + 1)]})
            yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    texts = arrow_stage(docs, named, "half long, lang string, text string")
    held = texts.join(asked, "half").select("lang", "text", "asked")
    made = arrow_stage(held, stage, _MADE)
    # copies of a document, or of its pointer's half, give a phrase more than once
    return written(made.dropDuplicates(["n", "fp", "check"]), "phrases")


_PARTS = pa.list_(pa.struct([("fp", pa.int64()), ("check", pa.int32())]))
_SCHEMA = pa.schema([("n", pa.int8()), ("fp", pa.int64()), ("check", pa.int32()),
                     ("seed", pa.int64()), ("lang", pa.string()), ("phrase", pa.string()),
                     ("left", _PARTS), ("right", _PARTS), ("inner", _PARTS)])


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST,
                 covered: int = COVERED, top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best ``top`` phrases of
    ``docs`` (doc_id, text, lang). ``bits`` is the width of the fingerprints."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    docs = docs.select(F.xxhash64(F.col("doc_id").cast("string"), lang, text).alias("key"),
                       lang.alias("lang"), text.alias("text"))
    counted = _counts(docs, [1, 2], None, least, bits)
    tables = [counted.filter("n > 0")]
    for n in range(3, longest + 1):
        shorter = Bloom.build(tables[-1].filter(f"n = {n - 1}").select("fp"), "fp", 1 << 26)
        tables.append(_counts(docs, [n], shorter, least, bits))
    every = tables[0]
    for t in tables[1:]:
        every = every.union(t)
    mixed = every.filter("lo <> hi")
    frequent = every.filter("lo = hi").select("n", "fp", F.col("lo").alias("check"), "c", "ptr")
    if not mixed.isEmpty():
        frequent = frequent.union(_recounted(docs, mixed, least, longest, bits))
    frequent = written(frequent, "frequent")
    made = _materialised(docs, frequent, longest, bits)

    counts = frequent.select("n", "fp", "check", "c")
    candidates = written(made.join(counts, ["n", "fp", "check"]), "candidates")
    side = frequent.select("fp", "check", "c")
    cuts = candidates.select("n", "fp", "check", F.col("c").alias("a"), F.posexplode(
        F.arrays_zip("left", "right")).alias("k", "cut"))
    cuts = cuts.select("n", "fp", "check", "a", "k", F.col("cut.left").alias("x"),
                       F.col("cut.right").alias("y"))
    for part, name in (("x", "l"), ("y", "r")):
        known = side.select(F.struct("fp", "check").alias(part), F.col("c").alias(name))
        cuts = cuts.join(known, part)
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")}
    square = (wide["a"] * wide["a"]).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    cuts = cuts.withColumn("top", square.cast("decimal(38,0)")).withColumn(
        "under", (wide["l"] * wide["r"]).cast("decimal(38,0)")).withColumn(
        "score", F.expr("top div under"))
    lowest = cuts.groupBy("n", "fp", "check").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("m"))
    longer = candidates.select(F.explode("inner").alias("i"), F.col("c").alias("f")).groupBy(
        F.col("i.fp").alias("fp"), F.col("i.check").alias("check")).agg(F.max("f").alias("f"))
    totals = counted.filter("n = 0").select(F.col("fp").alias("seed"), F.col("c").alias("words"))
    kept = (candidates.join(longer, ["fp", "check"], "left")
            .filter(f"f is null or 100 * f < {covered} * c")
            .join(lowest, ["n", "fp", "check"]).join(totals, "seed"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = kept.select("lang", "phrase", F.col("c").alias("a"), "m.l", "m.r",
                      F.col("words").alias("n"), "m.score")
    return out.withColumn("rank", F.row_number().over(best).cast("long")).filter(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
