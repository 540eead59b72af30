"""Secret scan: fixed patterns, and formats inferred from labelled credentials.

Base spans come from three fixed patterns (assign, access, hex). Their matches on a bounded
sample of documents are labelled credentials: for each kind they form a prefix tree over
character classes, whose statistically compatible states are merged (red-blue order,
Hoeffding bounds on the transition and ending frequencies) into a probabilistic automaton.
A further automaton of the same make is inferred from ordinary words. Every other candidate
(a run of credential characters beside the base spans, at least ``SHORTEST`` long) is scored
in its whole length by the log likelihood ratio per character against the ordinary words; it
is reported as kind ``format`` if some kind's ratio is positive and reaches the ratio that all
but ``MISSED`` of that kind's own labelled credentials reach. A candidate that is not reported
is parted at its separators (``SEPARATORS``, one after the other) and its parts are
candidates. Base spans always stay and overlap no candidate. The fit, unlike the scan, reads
the first ``LONGEST`` characters of a credential.

Scale. The fit uses at most ``SAMPLE`` credentials of a kind and as many ordinary words,
from about ``SAMPLE_ROWS`` rows chosen by a hash; the scan is one pass without a shuffle,
over whole texts, with array operations and literal searches for the common case.

Defined cases: a null text counts as empty; without labelled credentials there is no
automaton and only base spans are found. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateflow.llm.shared import arrow_stage, written
from lateflow.llm.words import row_slices, text_buffer

SAMPLE = 400
SAMPLE_ROWS = 20_000
SHORTEST, LONGEST = 16, 128
MISSED = 0.02
#: significance of the Hoeffding bound: smaller merges more
MERGE_ALPHA = 0.05
KINDS = ("assign", "access", "hex")
SEPARATORS = (b"=", b"/", b".", b"+", b"-", b"_")
_KEEP = 1 << 16

_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
_ASSIGN = re.compile(
    rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_VALUE = np.zeros(256, dtype=bool)
_VALUE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True
#: character classes: digit, a-f, g-z, A-F, G-Z, and each other character for itself
_CLASS = np.arange(256, dtype=np.int64)
for _k, _chars in enumerate((b"0123456789", b"abcdef", b"ghijklmnopqrstuvwxyz", b"ABCDEF",
                             b"GHIJKLMNOPQRSTUVWXYZ")):
    _CLASS[list(_chars)] = 1000 + _k
_SHAPE = bytes(b"0agAG"[c - 1000] if c >= 1000 else c for c in _CLASS.tolist())


class Automaton:
    """A probabilistic automaton merged from the prefix tree of class strings."""

    def __init__(self, samples: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.uses: list[dict[int, int]] = [{}]
        self.ends, self.seen = [0], [0]
        for classes in samples:
            node = 0
            self.seen[0] += 1
            for c in classes:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.uses.append({})
                    self.ends.append(0)
                    self.seen.append(0)
                self.uses[node][c] = self.uses[node].get(c, 0) + 1
                node = self.next[node][c]
                self.seen[node] += 1
            self.ends[node] += 1
        self.symbols = len({c for s in samples for c in s}) + 1
        self._merge_states()

    def _differ(self, k1: int, n1: int, k2: int, n2: int) -> bool:
        bound = math.sqrt(0.5 * math.log(2 / MERGE_ALPHA)) * (n1 ** -0.5 + n2 ** -0.5)
        return abs(k1 / n1 - k2 / n2) > bound

    def _compatible(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self.seen[a], self.seen[b]
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for c in self.uses[a].keys() | self.uses[b].keys():
                if self._differ(self.uses[a].get(c, 0), n, self.uses[b].get(c, 0), m):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    stack.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below b to the states reached from a."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.seen[a] += self.seen[b]
            self.ends[a] += self.ends[b]
            for c, n in self.uses[b].items():
                self.uses[a][c] = self.uses[a].get(c, 0) + n
                if c in self.next[a]:
                    stack.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge_states(self) -> None:
        red, at = [0], 0
        while at < len(red):
            for c in sorted(self.next[red[at]]):
                blue = self.next[red[at]][c]
                if blue in red:
                    continue
                for r in red:
                    if self._compatible(r, blue):
                        self.next[red[at]][c] = r
                        self._fold(r, blue)
                        break
                else:
                    red.append(blue)
            at += 1
            if any(x not in red for x in self.next[red[at - 1]].values()):
                at -= 1  # folding gave this state new successors
        self.states = red

    def logp(self, classes: list[int]) -> float:
        """Log likelihood of a class string and its end; unseen steps keep a small mass."""
        node, out = 0, 0.0
        for c in classes:
            if node is None:
                out -= math.log(self.symbols + 8)
                continue
            n = self.seen[node] + 1.0
            out += math.log((self.uses[node].get(c, 0) + 1.0 / (self.symbols + 8)) / n)
            node = self.next[node].get(c)
        n = self.seen[node] + 1.0 if node is not None else 2.0
        return out + math.log(((self.ends[node] if node is not None else 0) + 0.5) / n)


class Formats:
    """The automata of all kinds, the ordinary words', and each kind's threshold."""

    def __init__(self, labelled: dict[str, list[bytes]], ordinary: list[bytes]):
        classes = lambda x: _CLASS[np.frombuffer(x, np.uint8)].tolist()
        self.plain = Automaton([classes(x) for x in ordinary])
        self.kinds, self.least = {}, {}
        self.known: dict[bytes, bool] = {}
        for kind in KINDS:
            if labelled.get(kind):
                self.kinds[kind] = Automaton([classes(x) for x in labelled[kind]])
                ratios = sorted(self._ratio(self.kinds[kind], x) for x in labelled[kind])
                self.least[kind] = max(0.0, ratios[int(MISSED * len(ratios))])

    def _ratio(self, automaton: Automaton, x: bytes) -> float:
        classes = _CLASS[np.frombuffer(x, np.uint8)].tolist()
        return (automaton.logp(classes) - self.plain.logp(classes)) / len(x)

    def accepts(self, x: bytes) -> bool:
        shape = x.translate(_SHAPE)  # texts of one shape have one answer
        if shape not in self.known:
            if len(self.known) >= _KEEP:
                self.known.clear()
            found = False
            if self.kinds:
                classes = _CLASS[np.frombuffer(x, np.uint8)].tolist()
                plain = self.plain.logp(classes)
                for kind, automaton in self.kinds.items():
                    ratio = (automaton.logp(classes) - plain) / len(x)
                    found = found or ratio > 0 and ratio >= self.least[kind]
            if len(x) > LONGEST:
                return found
            self.known[shape] = found
        return self.known[shape]

    def spans(self, x: bytes, level: int = 0) -> list[tuple[int, int]]:
        """The accepted ranges of a run: itself, or else those of its parts."""
        if len(x) < SHORTEST:
            return []
        if self.accepts(x):
            return [(0, len(x))]
        while level < len(SEPARATORS) and SEPARATORS[level] not in x:
            level += 1
        if level == len(SEPARATORS):
            return []
        out, at = [], 0
        for part in x.split(SEPARATORS[level]):
            out += [(at + s, at + e) for s, e in self.spans(part, level + 1)]
            at += len(part) + 1
        return out


def _runs(mask: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = end - start >= shortest
    return start[long], end[long]


def base_spans(data: bytes, raw: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, kind number, end, start of the credential) of texts joined by newlines."""
    out = []
    lower = data.lower()
    spots = []
    for word in _KEYWORDS:
        at = lower.find(word)
        while at >= 0:
            spots.append(at)
            at = lower.find(word, at + 1)
    done = 0
    for at in sorted(spots):
        if at >= done and (m := _ASSIGN.match(data, at)):
            done = m.end()
            if m.end(1) - m.start(1) >= 6:
                out.append((at, 0, done, m.start(1)))
    out += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(data)
            if m.end() - m.start() >= 20]
    out += [(s, 2, e, s) for s, e in zip(*(x.tolist() for x in _runs(_HEX[raw], 24)))]
    return out


def _joined(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts with a newline after each, and where each begins (and the end)."""
    raw, offsets = text_buffer(column)
    raw = np.insert(raw, offsets[1:], 10)
    return raw.tobytes(), raw, offsets + np.arange(len(offsets))


def _labels(batch: pa.RecordBatch):
    """(kind, credential) of the base spans, and ordinary words as kind ``plain``."""
    for a, b in row_slices(batch.column(0)):
        data, raw, _ = _joined(batch.column(0).slice(a, b - a))
        spans = base_spans(data, raw)
        kinds = [KINDS[k] for _, k, _, _ in spans]
        found = [data[c:e][:LONGEST].decode() for _, _, e, c in spans]
        taken = np.zeros(len(raw), dtype=bool)
        for s, _, e, _ in spans:
            taken[s:e] = True
        start, end = _runs(_VALUE[raw], 6)
        step = max(1, len(start) // 200)
        for s, e in list(zip(start.tolist(), end.tolist()))[::step]:
            if not taken[s:e].any():
                kinds.append("plain")
                found.append(data[s:e][:LONGEST].decode())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()),
                                          pa.array(found, pa.string())], names=["kind", "x"])


def fit(docs: DataFrame, sample: int = SAMPLE, sample_rows: int = SAMPLE_ROWS) -> Formats:
    """Automata from at most ``sample`` credentials of a kind, out of about ``sample_rows``
    rows of ``docs`` (text)."""
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text is not null")
    share = min(1.0, sample_rows / max(1, texts.count()))
    place = F.shiftrightunsigned(F.xxhash64("text"), 11) / float(1 << 53)
    found = written(arrow_stage(texts.filter(place < share), _labels,
                                "kind string, x string").distinct(), "labels")
    rows = []
    for kind in (*KINDS, "plain"):
        rows += found.filter(F.col("kind") == kind).orderBy(F.xxhash64("x"), "x").limit(
            sample).collect()
    return Formats({k: [r["x"].encode() for r in rows if r["kind"] == k] for k in KINDS},
                   [r["x"].encode() for r in rows if r["kind"] == "plain"])


def scan(docs: DataFrame, formats: Formats) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each row."""

    def stage(batch: pa.RecordBatch):
        ids, texts = batch.column(0), batch.column(1)
        empty = hashlib.sha256(b"").hexdigest()
        for a, b in row_slices(texts):
            n = b - a
            data, raw, begin = _joined(texts.slice(a, n))
            spans = base_spans(data, raw)
            taken = np.zeros(len(raw), dtype=bool)
            for s, _, e, _ in spans:
                taken[s:e] = True
            start, end = _runs(_VALUE[raw] & ~taken, SHORTEST)
            marks = b"".join(SEPARATORS)
            for s, e in zip(start.tolist(), end.tolist()):
                run = data[s:e]
                if s and taken[s - 1]:  # what is left beside a base span
                    s += len(run) - len(run := run.lstrip(marks))
                if taken[e]:
                    run = run.rstrip(marks)
                spans += [(s + x, 3, s + y, s + x) for x, y in formats.spans(run)]
            spans.sort()
            counts = np.zeros((3, n), dtype=np.int64)
            hashes, texts_ = [empty] * n, [""] * n
            rows = np.searchsorted(begin, [s for s, *_ in spans], side="right") - 1
            at = 0
            while at < len(spans):
                row = int(rows[at])
                stop = int(np.searchsorted(rows, row, side="right"))
                lo = int(begin[row])
                points = np.concatenate(([0], np.cumsum(
                    (raw[lo:begin[row + 1]] & 0xC0) != 0x80)))
                named = [(k, f"{(*KINDS, 'format')[k]}:{points[s - lo]}:{points[e - lo]}")
                         for s, k, e, _ in spans[at:stop]]
                for k, _ in named:
                    if k < 3:
                        counts[k, row] += 1
                base = ",".join(x for k, x in named if k < 3)
                hashes[row] = hashlib.sha256(base.encode()).hexdigest()
                texts_[row] = ",".join(x for _, x in named)
                at = stop
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, n), *(pa.array(c) for c in counts), pa.array(hashes, pa.string()),
                 pa.array(texts_, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return arrow_stage(rows, stage, "doc_id long, n_assign long, n_access long, n_hex long, "
                                    "base_sha256 string, spans string")
