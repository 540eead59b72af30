"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: words in lower case without the punctuation
around them, with numbers, units (after a number) and names (a capitalised word that does
not begin a sentence) replaced by typed placeholders. Windows of ``WINDOW`` template tokens
are hashed and joined by hash with the windows of the benchmark items, so a question whose
numbers or names were changed still meets its item. Items of up to 20 tokens have shorter
windows, so that one changed word leaves enough of them (from 13 tokens on; items of fewer
than ``WINDOW`` tokens are one window). A second form of each text keeps names as words, for
texts in other letter case. A third, broad form takes every capitalised word but A and I as a
name, numbers as words (English, Spanish, French, German) or with their unit attached as
numbers, and a run of names, or a number's words and its unit, as one token. The exact form keeps all words, numbers, names
and signs (+ * / =) as they are and asks for no plain words, so that verbatim copies of items
dense in numbers or names match. In scripts without white space each character is a word.

A match has to be consistent: along matches at one alignment of document and item, what
fills a placeholder in the item has to stand for one thing in the document (two things may
become the same one). Where it stands for several, the windows that hold it don't count,
unless they agree word for word; all other windows do. A document is contaminated by an item
if its counted matches at some alignment, or at ``SLACK`` + 1 neighbouring ones together,
cover ``SHARE`` of the item's windows, or ``RUN`` of them, and at least as many tokens as one
full window (or the item) has.

Scale. Document windows are filtered by a Bloom filter of fixed size before they leave the
scan, so only likely matches are shuffled; the join behind it is exact. Its size does not
depend on the benchmark; a larger benchmark lets more windows through to the join.

Defined cases: null and empty texts match nothing. Placeholder windows with fewer than
``LITERALS`` words, and whole items of fewer than ``LEAST`` tokens, are too unspecific to be
looked for with placeholders; their exact copies are found, wherever they stand. An item of
one word is found where it is the whole text, as a word by itself says nothing of where it is
from. A null item_id is an item of its own; repeated rows are each decided.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lateflow.llm.shared import Bloom, U64, arrow_stage, keeps, written
from lateflow.llm.words import Words, mix, row_slices, text_buffer

WINDOW = 8
LEAST = 5
LITERALS = 4
SHARE = 0.4
RUN = 13
#: words that may be put in or left out between matches that are counted together
SLACK = 3
LEAST_EXACT = 1
GROUPS, EXACT = 3, 2
UNITS = frozenset(
    "% ° kg g mg lb lbs oz t km m cm mm mi ft in yd l ml h hr hrs hour hours min mins minute "
    "minutes s sec secs second seconds ms day days week weeks month months year years mph "
    "kmh km/h m/s w kw kwh v a hz khz mhz ghz j kj cal kcal pa kpa usd eur gbp dollar dollars "
    "cent cents euro euros pound pounds percent degree degrees meter meters metre metres "
    "kilometer kilometers gram grams kilogram kilograms liter liters litre litres mile miles "
    "inch inches foot feet °c °f kb mb gb tb".split())
_EDGE = " \t\r\n.,;:!?\"'()[]{}<>«»“”‘’…*#&|_~`^=+\\/。、，．！？：；「」『』（）《》【】"
NUMBER, UNIT, NAME, DROP, ATTACHED, SPELT, CAPS, SIGN = range(1, 9)
_SIGNS = frozenset("+*/=<>^×÷·|~#&_\\")
#: characters of scripts that put no white space between words
_UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
_LEADS = np.zeros(256, dtype=bool)  # first bytes that may begin one of them
_LEADS[[0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0]] = True
_ATTACHED = re.compile(r"(\d[\d.,:/]*)([^\W\d].*)")
_SPELT = {word: str(n) for words in (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen",
    "- - dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince "
    "dieciséis diecisiete dieciocho diecinueve",
    "- - deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize "
    "dix-sept dix-huit dix-neuf",
    "null - zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn "
    "fünfzehn sechzehn siebzehn achtzehn neunzehn") for n, word in enumerate(words.split())}
_SPELT |= {word: str(n) for words in (
    "twenty thirty forty fifty sixty seventy eighty ninety hundred",
    "veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien",
    "vingt trente quarante cinquante soixante soixante-dix quatre-vingts quatre-vingt-dix cent",
    "zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert")
    for n, word in zip(range(20, 101, 10), words.split())}
_SPELT |= dict.fromkeys("thousand mil mille tausend".split(), "1000") | dict.fromkeys(
    "million millions millón millones".split(), "1000000")
_SPELT.pop("-")
_CODES = mix(np.arange(100, 105, dtype=U64))
_KEEP = 1 << 18
_words: dict[str, tuple] = keeps({})


def _kind(word: str) -> tuple[str, int, bool, str]:
    """(word as a template token, kind of it, whether it ends a sentence, what it fills a
    broad placeholder with). Kinds: 0 word, NUMBER, UNIT (also a word), NAME (if not first in
    its sentence), DROP, SIGN (a token of the exact form only); words that are placeholders in the broad form only: ATTACHED (a
    number with its unit), SPELT (a number), CAPS (a name)."""
    ends = word.rstrip("\"')]»”’*")[-1:] in (".", "!", "?", "…", ":", "。", "！", "？", "：")
    core = word.strip(_EDGE)
    if not core:
        if (unit := word.strip(".,;:")) in UNITS:
            return unit, UNIT, ends, unit
        return word, SIGN if _SIGNS.intersection(word) else DROP, ends, ""
    money = core.lstrip("$€£-").rstrip("%")
    if money[:1].isdigit() and money.replace(",", "").replace(".", "").replace(
            ":", "").replace("/", "").isdigit():
        return core, NUMBER, ends, money
    lower = core.lower()
    if lower in UNITS:
        return lower, UNIT, ends, lower
    if (m := _ATTACHED.fullmatch(money)) and m[2].lower() in UNITS:
        return lower, ATTACHED, ends, m[1]
    parts = [lower] if lower in _SPELT else lower.split("-")
    if all(x in _SPELT for x in parts):
        return lower, SPELT, ends, "-".join(_SPELT[x] for x in parts)
    if core[0].isupper() and core not in ("A", "I"):
        return lower, NAME if core[1:] and not core.isupper() else CAPS, ends, lower
    return lower, 0, ends, lower


def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a byte is to ``_plain`` (the bits below), and the characters of two bytes that a
    plain word may hold, and of these the lower-case letters."""
    byte = np.zeros(256, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        byte[b] = (_IN_EDGE * (c in _EDGE) | _TAIL * (c in "\"')]*") | _STOP * (c in ".!?:")
                   | _UPPER * c.isupper() | _LOWER * c.islower()
                   | _ODD * (c == "-" or (c.isspace() and c not in " \t\n\v\f\r")))
    byte[128:] = _ODD
    byte[0xC2:0xE0] = _LEAD
    byte[0x80:0xC0] = _NEXT
    two = [chr(c) for c in range(0x800)]
    same = np.array([c.lower() == c and not (c.isupper() or c.isnumeric() or c.isspace())
                     and c not in _EDGE + "£" for c in two])
    return byte, same, np.array([c.islower() for c in two]) & same


_IN_EDGE, _TAIL, _STOP, _UPPER, _LOWER, _ODD, _LEAD, _NEXT = (1 << i for i in range(8))
_BYTES, _SAME, _SMALL = _classes()
#: hashes of the words that are units or numbers
_LISTED = np.sort(Words(*text_buffer(pa.array(sorted(UNITS | _SPELT.keys())))).hash)


def _plain(words: Words):
    """Which words ``_kind`` calls a word or a name by their letters alone, and for these the
    literal hash, kind and sentence end, without a step per word: those that begin (behind
    ASCII signs) with a letter and hold only ASCII but hyphens and characters of two bytes
    that lower case leaves as they are, and are no unit or number."""
    n = len(words)
    byte = _BYTES[words.raw]
    fine = np.ones(n, dtype=bool)
    odd, small = (byte & _ODD) > 0, (byte & _LOWER) > 0
    lead = np.flatnonzero(byte & _LEAD)
    follows = np.zeros(len(byte) + 1, dtype=bool)
    follows[lead + 1] = True
    odd |= follows[:-1] != ((byte & _NEXT) > 0)
    odd[words.start] |= (byte[words.start] & _NEXT) > 0
    odd[words.end - 1] |= (byte[words.end - 1] & _LEAD) > 0
    lead = lead[lead + 1 < len(byte)]
    code = ((words.raw[lead] & 31).astype(np.int64) << 6) | (words.raw[lead + 1] & 63)
    odd[lead] |= ~_SAME[code]
    small[lead] = _SMALL[code]
    fine[np.searchsorted(words.start, np.flatnonzero(odd), side="right") - 1] = False
    # the word without the signs around it
    first, last = words.start.copy(), words.end - 1
    core = np.flatnonzero((byte & _IN_EDGE) == 0)
    for spot, behind in ((first, 0), (last, 1)):
        some = np.flatnonzero(byte[spot] & _IN_EDGE)
        at = np.searchsorted(core, spot[some]) - behind
        inside = (at >= 0) & (at < len(core))
        spot[some[inside]] = core[at[inside]]
        fine[some[~inside]] = False
    fine &= (first <= last) & (first < words.end) & (last >= words.start)
    fine[fine] &= (byte[first[fine]] & (_UPPER | _LOWER | _LEAD)) > 0
    at = np.flatnonzero(fine)
    first, last = first[at], last[at]
    literal = words.hashes(first, last + 1)
    spot = np.minimum(np.searchsorted(_LISTED, literal), len(_LISTED) - 1)
    fresh = _LISTED[spot] != literal
    at, first, last, literal = at[fresh], first[fresh], last[fresh], literal[fresh]
    kind = np.zeros(len(at), dtype=np.int8)
    big = np.flatnonzero(byte[first] & _UPPER)
    big = big[(last[big] > first[big]) | ~np.isin(words.raw[first[big]], list(b"AI"))]
    lows = np.flatnonzero(small)
    kind[big] = np.where(np.searchsorted(lows, first[big]) < np.searchsorted(
        lows, last[big], side="right"), NAME, CAPS)
    mark = words.end[at] - 1
    some = np.flatnonzero(byte[mark] & _TAIL)
    tail = np.flatnonzero((byte & _TAIL) == 0)
    mark[some] = tail[np.searchsorted(tail, mark[some]) - 1]
    return at, literal, kind, (byte[mark] & _STOP) > 0


def _tokens(words: Words):
    """Per word: literal hash, kind, sentence end and the hash of what fills a broad
    placeholder. Plain words are done together, the others from a table of distinct words."""
    n = len(words)
    out = (np.zeros(n, U64), np.zeros(n, np.int8), np.zeros(n, bool), np.zeros(n, U64))
    rest = np.ones(n, dtype=bool)
    if n:
        at, literal, kind, ends = _plain(words)
        for o, a in zip(out, (literal, kind, ends, literal)):
            o[at] = a
        rest[at] = False
    at = np.flatnonzero(rest)
    if len(at):
        for o, a in zip(out, _listed(words, at)):
            o[at] = a
    return out


def _listed(words: Words, which: np.ndarray):
    """What ``_kind`` says of these words, from a table of distinct words."""
    key = words.hashes(words.start[which], words.end[which], words.raw)
    h, at, index = np.unique(key, return_index=True, return_inverse=True)
    at = which[at]
    known, lit, kind, ends, fill = _words.get("t", (
        np.zeros(0, U64), np.zeros(0, U64), np.zeros(0, np.int8), np.zeros(0, bool),
        np.zeros(0, U64)))
    spot = np.searchsorted(known, h)
    hit = np.zeros(len(h), dtype=bool)
    inside = spot < len(known)
    hit[inside] = known[spot[inside]] == h[inside]
    out = [np.zeros(len(h), a.dtype) for a in (lit, kind, ends, fill)]
    for o, a in zip(out, (lit, kind, ends, fill)):
        o[hit] = a[spot[hit]]
    new = np.flatnonzero(~hit)
    if len(new):
        raw = [words.raw[words.start[i]:words.end[i]].tobytes().decode(errors="replace")
               for i in at[new]]
        found = [_kind(w) for w in raw]
        out[1][new] = [k for _, k, *_ in found]
        out[2][new] = [e for *_, e, _ in found]
        for o, texts in ((out[0], [t for t, *_ in found]), (out[3], [f for *_, f in found])):
            o[new] = Words(*text_buffer(pa.array(
                ["".join(t.split()) or "." for t in texts]))).hash
        if len(known) + len(new) > _KEEP:
            known, lit, kind, ends, fill = (x[:0] for x in (known, lit, kind, ends, fill))
            hit[:] = False
            new = np.arange(len(h))
        merged = np.concatenate((known, h[new]))
        order = np.argsort(merged)
        _words["t"] = (merged[order], *(np.concatenate((a, o[new]))[order]
                                        for a, o in zip((lit, kind, ends, fill), out)))
    return tuple(o[index] for o in out)


class Form:
    """Tokens of a slice in one form: row, hash, placeholder kind (0: a word) and filler.
    Forms of one group have the same tokens, so that their windows may meet."""

    def __init__(self, group: int, doc, code, kinds, fill):
        self.group, self.doc, self.code, self.kinds, self.fill = group, doc, code, kinds, fill
        self.words = np.concatenate(([0], np.cumsum(kinds == 0)))


class Template:
    """The forms of a slice: names as placeholders, names as words, and the broad form, in
    which any capitalised word is a name, numbers may be spelt or carry their unit, and a
    run of names, or of a number's words and its unit, is one token; and the exact form, all
    words and signs as they are."""

    def __init__(self, words: Words):
        literal, kind, ends, fill = _tokens(words)
        n = len(words)
        before_ends = np.ones(n, dtype=bool)
        if n:
            before_ends[1:] = ends[:-1] | (words.doc[1:] != words.doc[:-1])
        slot = np.where(kind == NUMBER, NUMBER, 0)
        prior = np.zeros(n, dtype=bool)
        prior[1:] = (kind[:-1] == NUMBER) & (words.doc[1:] == words.doc[:-1])
        slot[(kind == UNIT) & prior] = UNIT
        named = slot.copy()
        named[(kind == NAME) & ~before_ends] = NAME
        keep = np.flatnonzero((kind != DROP) & (kind != SIGN))
        doc, lit = words.doc[keep], literal[keep]
        self.forms = []
        for form in (named, slot):
            kinds = form[keep]
            self.forms.append(Form(0, doc, np.where(kinds > 0, _CODES[kinds], lit), kinds, lit))
        comma = np.isin(words.raw[words.end - 1], list(b",;")) if n else ends
        self.forms.append(self._broad(doc, lit, kind[keep], (ends | comma)[keep], fill[keep]))
        said = np.flatnonzero(kind != DROP)
        self.forms.append(Form(2, words.doc[said], literal[said],
                               np.zeros(len(said), dtype=np.int64), literal[said]))

    @staticmethod
    def _broad(doc, literal, kind, ends, fill) -> Form:
        slot = np.zeros(len(kind), dtype=np.int64)
        slot[(kind == NUMBER) | (kind == ATTACHED) | (kind == SPELT)] = NUMBER
        slot[(kind == NAME) | (kind == CAPS)] = NAME
        run = np.zeros(len(kind), dtype=bool)
        run[1:] = (doc[1:] == doc[:-1]) & ~ends[:-1]
        after = np.zeros(len(kind), dtype=bool)
        after[1:] = (kind[:-1] == NUMBER) | (kind[:-1] == SPELT)
        unit = run & after & (kind == UNIT)
        run[1:] &= (slot[1:] > 0) & (slot[1:] == slot[:-1])
        first = np.flatnonzero(~(run | unit))
        if len(first):
            fill = np.add.reduceat(np.where((slot > 0) & ~unit, fill, U64(0)), first)
        kinds = slot[first]
        return Form(1, doc[first], np.where(kinds > 0, _CODES[kinds], literal[first]), kinds,
                    fill)

    def windows(self, sizes: dict[int, set[int]]):
        """(form, size, first tokens, hashes) of the specific windows of each group's sizes;
        the second form only where it differs from the first."""
        named = {}
        for number, form in enumerate(self.forms):
            wanted = sizes.get(form.group, ())
            acc = np.full(len(form.code), 1 + form.group, dtype=U64)
            for k in range(min(max(wanted, default=0), len(acc))):
                size, many = k + 1, len(form.code) - k
                with np.errstate(over="ignore"):
                    acc = acc[:many] + form.code[k:] * (_CODES[0] * U64(2 * k + 1) | U64(1))
                    if size not in wanted:
                        continue
                    fine = form.doc[:many] == form.doc[k:]
                    if form.group != EXACT:
                        fine &= form.words[size:] - form.words[:many] >= min(LITERALS, size)
                    if number == 0:
                        named[size] = acc
                    elif number == 1:
                        fine &= acc != named.pop(size)
                    at = np.flatnonzero(fine)
                    yield number, size, at, mix(acc[at] + U64(size << 8))


def window_size(tokens: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Tokens of a window of items of so many tokens (0: fewer than ``least``): the most, up
    to WINDOW, for which one changed word leaves SHARE of the windows, but at least LEAST."""
    size = np.clip((1 - SHARE) * (tokens + 1) / (2 - SHARE) + 1e-9, LEAST, WINDOW).astype(int)
    return np.where(tokens < least, 0, np.where(tokens < WINDOW, tokens, size))


def _spaced(column: pa.Array) -> pa.Array:
    """The texts with a space around each character of a script without white space."""
    if not _LEADS[text_buffer(column)[0]].any():
        return column
    # as large strings: the spaces may take more than 2 GB
    return pc.replace_substring_regex(column.cast(pa.large_string()), _UNSPACED, r" \0 ")


def _windows(column: pa.Array, sizes: dict[int, set[int]], wanted: Bloom | None):
    """(row, size, form, position, tokens of the row, hash, fillers) of the windows of each
    text that the filter may hold; fillers are (kind, filler) of the window's placeholders.
    Without a filter the texts are items, with windows of the items' own sizes."""
    words = Words(*text_buffer(_spaced(column)))
    t = Template(words)
    counts = [np.bincount(f.doc, minlength=len(column)) for f in t.forms]
    begins = [np.cumsum(c) - c for c in counts]
    out = []
    for number, size, at, h in t.windows(sizes):
        form, count, begin = t.forms[number], counts[number], begins[number]
        if wanted is not None:
            some = wanted.holds(h)
            if size == 1:
                some &= count[form.doc[at]] == 1
        else:
            least = LEAST_EXACT if form.group == EXACT else LEAST
            some = window_size(count, least)[form.doc[at]] == size
        at, h = at[some], h[some]
        for a, x in zip(at.tolist(), h.view(np.int64).tolist()):
            spots = [a + i for i in range(size) if form.kinds[a + i]]
            row = int(form.doc[a])
            out.append((row, size, number, a - int(begin[row]), int(count[row]), x,
                        [int(form.kinds[s]) for s in spots],
                        form.fill[spots].view(np.int64).tolist() if spots else []))
    return out, counts[0]


_HIT = "struct<size:int,form:int,at:int,tokens:int,h:long,kinds:array<int>,fillers:array<long>>"


def _hits(sizes, wanted: Bloom | None, id_name: str):
    kind = pa.list_(pa.struct([("size", pa.int32()), ("form", pa.int32()), ("at", pa.int32()),
                               ("tokens", pa.int32()), ("h", pa.int64()), ("kinds", pa.list_(pa.int32())),
                               ("fillers", pa.list_(pa.int64()))]))

    def stage(batch: pa.RecordBatch):
        ids, texts = batch.column(0), batch.column(1)
        for a, b in row_slices(texts):
            found, count = _windows(texts.slice(a, b - a), sizes, wanted)
            rows = [[] for _ in range(b - a)]
            for row, size, form, at, tokens, h, kinds, fillers in found:
                rows[row].append({"size": size, "form": form, "at": at, "tokens": tokens,
                                  "h": h, "kinds": kinds, "fillers": fillers})
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(count.astype(np.int32)), pa.array(rows, kind)],
                names=[id_name, "n", "hits"])

    return stage


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key (hash of doc_id and text), contaminated, n_items and item_ids (sorted) of
    each row of ``docs`` (doc_id, text) against ``benchmark`` (item_id, text)."""
    items = written(arrow_stage(
        benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")),
        _hits({g: set(range(LEAST_EXACT, WINDOW + 1)) for g in range(GROUPS)}, None, "item_id"),
        f"item_id long, n int, hits array<{_HIT}>").withColumn(
            "item", F.monotonically_increasing_id()), "items")
    asked = items.select("item", "item_id", F.explode("hits").alias("i")).select(
        "item", "item_id", "i.*")
    asked = asked.withColumn("windows", F.count(F.lit(1)).over(
        Window.partitionBy("item", "form")))
    asked = written(asked, "asked")
    group = F.greatest(F.col("form") - 1, F.lit(0))
    sizes: dict[int, set[int]] = {}
    for r in asked.select(group.alias("g"), "size").distinct().collect():
        sizes.setdefault(r["g"], set()).add(r["size"])
    wanted = Bloom.build(asked.select("h"), "h", 1 << 24)
    text = F.col("text").cast("string")
    found = written(arrow_stage(
        docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                             F.xxhash64(F.col("doc_id").cast("long"), text).alias("key")).alias(
                                 "id"), text.alias("text")),
        _hits(sizes, wanted, "id"),
        f"id struct<doc_id:long,key:long>, n int, hits array<{_HIT}>").withColumn(
            "row", F.monotonically_increasing_id()), "hits")
    hits = found.select("row", F.explode("hits").alias("d")).select("row", "d.*")
    both = hits.alias("d").join(asked.alias("i"), "h")
    pairs = written(both.select(
        "row", "item", "item_id", F.greatest(F.col("i.form") - 1, F.lit(0)).alias("group"),
        F.col("i.windows").alias("windows"),
        (F.least(F.col("i.tokens"), F.lit(WINDOW)) - F.col("i.size") + 1).alias("least"),
        F.col("d.form").alias("df"), F.col("i.form").alias("if"), F.col("i.at").alias("at"),
        (F.col("d.at") - F.col("i.at")).alias("shift"),
        F.arrays_zip(F.col("i.kinds").alias("k"), F.col("i.fillers").alias("x"),
                     F.col("d.fillers").alias("y")).alias("slots")), "pairs")
    # each shift for itself, and bands of SLACK + 1 neighbouring shifts
    places = F.array(*[F.struct((F.col("shift") - k).alias("shift"), F.lit(band).alias("band"))
                       for band in (0, 1) for k in range(SLACK * band + 1)])
    pairs = pairs.withColumn("p", F.explode(places)).withColumnRenamed("shift", "own").select(
        "*", "p.*").drop("p")
    place = ["row", "item", "group", "shift", "band"]
    window = [*place, "own", "at", "df", "if"]
    slots = pairs.filter(F.exists("slots", lambda s: s["x"] != s["y"])).select(
        *window, F.explode("slots").alias("s")).select(*window, "s.*")
    every = pairs.select(*place, F.explode("slots").alias("s")).select(*place, "s.*")
    clash = every.groupBy(*place, "k", "x").agg(
        F.min("y").alias("first"), F.max("y").alias("last")).filter("first <> last")
    bad = slots.join(clash, [*place, "k", "x"]).select(*window).distinct()
    fits = pairs.join(bad, window, "left_anti").groupBy(*place, "item_id").agg(
        F.count_distinct("at").alias("got"), F.max("windows").alias("windows"),
        F.min("least").alias("least"))
    fits = fits.filter("got >= least").filter((F.col("got") >= SHARE * F.col("windows")) | (F.col("got") >= RUN))
    by_row = fits.groupBy("row").agg(F.count_distinct("item").alias("n_items"),
                                     F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    return found.select("row", "id").join(by_row, "row", "left").select(
        "id.doc_id", "id.key", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"))

