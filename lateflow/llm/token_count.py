"""Token counts by a byte-pair tokenizer compiled to finite-state transducers.

Two deterministic machines are compiled from the tokenizer's public file.

* The splitter resets at white space, where the tokenizer always cuts. The texts of a slice
  are one byte stream; the state map of a run of bytes between two resets is (state after
  the reset, emitted count), whatever state came in, so the maps of all runs compose by one
  parallel prefix scan (running sums, read off at the texts' ends) instead of a sequential
  pass over each text, and equal runs share one map.
* The word transducer walks the byte trie of the vocabulary. Its state is the last token
  emitted; reading a token's bytes is a transition to that token annotated with one emitted
  token, allowed iff the two tokens can stand side by side: no merge across their boundary
  would come before the merges that build them. Of all token sequences that spell a word,
  exactly one has only allowed transitions, and it is the one that the merges produce. So
  the count of every prefix is known left to right, for many words (lanes) at a time.

Which pairs of tokens may stand side by side is decided by a walk up the two merge trees,
vectorised, and remembered as a transition table that grows with the pairs that occur.

Defined cases: null and empty texts have 0 tokens. Special strings in a text count as one
token each, as the library's default has it.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateflow.llm.lattice import Trie
from lateflow.llm.shared import arrow_stage, keeps
from lateflow.llm.words import U64, Words, row_slices, text_buffer

CELLS = 1 << 18
KEEP_WORDS = 1 << 20
KEEP_PAIRS = 1 << 21
_NONE = np.int64(1 << 40)  # a rank later than all merges
_WORD_END = "</w>"


def _byte_letters() -> dict[str, int]:
    """The letters with which byte-level vocabularies spell the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Machine:
    """The compiled tokenizer. ``spec`` is the text of a tokenizer file: byte-level pair
    merges with word ends, a split pattern, and NFC, white space and lower case rules."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != _WORD_END:
            raise ValueError("this machine compiles byte-level merges with word ends")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalisation {kinds}")
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # the added alternative keeps the blanks put between words apart from the tokens
        self.split = regex.compile(f"{split}|\\n")
        letters = _byte_letters()
        ids = model["vocab"]
        n = len(ids)
        parts = np.full((n, 2), -1, dtype=np.int64)
        rank = np.full(n, -1, dtype=np.int64)  # of the merge that makes a token
        pairs = np.empty(len(model["merges"]), np.int64)
        for r, (a, b) in enumerate(model["merges"]):
            t = ids[a + b]
            pairs[r] = ids[a] * n + ids[b]
            if rank[t] < 0:
                rank[t], parts[t] = r, (ids[a], ids[b])
        order = np.argsort(pairs, kind="stable")
        self.n, self.parts, self.rank = n, parts, rank
        self.pair_keys, self.pair_ranks = pairs[order], order
        spelled = {}
        for s, t in ids.items():
            end = s.endswith(_WORD_END)
            raw = bytes(letters[c] for c in (s[:-4] if end else s))
            if 0xFF not in raw:  # never occurs in UTF-8, so it can mark the word's end
                spelled[t] = raw + b"\xff" * end
        usable = self._reachable()
        self.tokens = np.array(sorted(t for t in spelled if usable[t]), dtype=np.int64)
        self.trie = Trie([spelled[t] for t in self.tokens.tolist()])
        self.known = np.zeros(0, np.int64)  # pairs decided so far, and the answer
        self.allowed = np.zeros(0, bool)
        self.words = (np.zeros(0, U64), np.zeros(0, np.int64))

    def _merge_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        key = x * self.n + y
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)

    def _spine(self, token: np.ndarray, side: int) -> list[np.ndarray]:
        """From each token down its first (0) or last (1) parts; the last entry repeats."""
        out = [token]
        while True:
            below = self.parts[out[-1], side]
            if (below < 0).all():
                return out
            out.append(np.where(below < 0, out[-1], below))

    def first_crossing(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the first merge over the boundary of each pair of tokens while both are
        built up from bytes; ``_NONE`` if there is none."""
        lefts, rights = np.stack(self._spine(left, 1)), np.stack(self._spine(right, 0))
        i = np.full(len(left), len(lefts) - 1)
        j = np.full(len(left), len(rights) - 1)
        lane = np.arange(len(left))
        out = np.full(len(left), _NONE)
        live = np.ones(len(left), dtype=bool)

        def parent_rank(spine, at):
            """When the node at a spine position is merged away, walking over repeats."""
            up = np.maximum(at - 1, 0)
            return np.where(at == 0, _NONE, self.rank[spine[up, lane]])

        while live.any():
            # repeats of a leaf at the end of a shorter spine
            for spine, at in ((lefts, i), (rights, j)):
                while True:
                    up = np.maximum(at - 1, 0)
                    same = (at > 0) & (spine[up, lane] == spine[at, lane])
                    if not same.any():
                        break
                    at[same] -= 1
            x, y = lefts[i, lane], rights[j, lane]
            m, rx, ry = self._merge_rank(x, y), parent_rank(lefts, i), parent_rank(rights, j)
            # of equal ranks the leftmost merge is first: the left part's own merge wins
            # against the crossing one, which wins against the right part's own
            cross = live & (m < rx) & (m <= ry) & (m < _NONE)
            out[cross] = m[cross]
            live &= ~cross & ((rx < _NONE) | (ry < _NONE))
            left_first = live & (rx <= ry)
            i[left_first] -= 1
            j[live & ~left_first] -= 1
        return out

    def _reachable(self) -> np.ndarray:
        """Tokens that the merges can produce from their own bytes."""
        out = self.rank < 0
        made = np.flatnonzero(self.rank >= 0)
        a, b = self.parts[made].T
        fine = self.first_crossing(a, b) == self.rank[made]
        out[made] = fine
        order = made[np.argsort(self.rank[made])]
        for t in order.tolist():  # parts come before the whole
            a, b = self.parts[t]
            out[t] = out[t] and out[a] and out[b]
        return out

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens is a transition of the word transducer."""
        key = left * self.n + right
        at = np.searchsorted(self.known, key)
        hit = np.zeros(len(key), dtype=bool)
        inside = at < len(self.known)
        hit[inside] = self.known[at[inside]] == key[inside]
        out = np.zeros(len(key), dtype=bool)
        out[hit] = self.allowed[at[hit]]
        if not hit.all():
            new, back = np.unique(key[~hit], return_inverse=True)
            yes = self.first_crossing(new // self.n, new % self.n) == _NONE
            out[~hit] = yes[back]
            if len(self.known) > KEEP_PAIRS:
                self.known, self.allowed = self.known[:0], self.allowed[:0]
            merged = np.concatenate((self.known, new))
            order = np.argsort(merged, kind="stable")
            merged, answers = merged[order], np.concatenate((self.allowed, yes))[order]
            first = np.ones(len(merged), dtype=bool)
            first[1:] = merged[1:] != merged[:-1]
            self.known, self.allowed = merged[first], answers[first]
        return out

    def count_tokens(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each pretoken raw[start:end]."""
        out = np.zeros(len(start), dtype=np.int64)
        length = end - start + 1  # with the end mark
        order = np.argsort(-length, kind="stable")
        at = 0
        while at < len(order):
            longest = int(length[order[at]])
            block = order[at:at + max(1, CELLS // longest)]
            size = length[block]
            spots = start[block][None, :] + np.arange(longest)[:, None]
            bytes_ = raw[np.minimum(spots, len(raw) - 1)]
            bytes_[size - 1, np.arange(len(block))] = 0xFF
            out[block] = self._run(bytes_, size)
            at += len(block)
        return out

    def _run(self, bytes_: np.ndarray, size: np.ndarray) -> np.ndarray:
        longest, lanes = bytes_.shape
        last = np.full((longest + 1, lanes), -1, dtype=np.int64)
        emitted = np.full((longest + 1, lanes), -1, dtype=np.int64)
        emitted[0] = 0
        trie = self.trie
        for i in range(longest):
            live = int(np.searchsorted(-size, -i, side="left"))
            lane = np.flatnonzero(emitted[i, :live] >= 0)
            row = np.ones(len(lane), dtype=np.int32)
            j = i
            while len(lane):
                node = trie.step(row, bytes_[j, lane])
                j += 1
                some = node > 0
                lane, node = lane[some], node[some]
                piece = trie.piece[node]
                ends = piece >= 0
                if ends.any():
                    to, token = lane[ends], self.tokens[piece[ends]]
                    if i:
                        fine = self.may_follow(last[i, to], token)
                        to, token = to[fine], token[fine]
                    last[j, to] = token
                    emitted[j, to] = emitted[i, to] + 1
                row = trie.row[node]
                on = (row > 0) & (size[lane] > j)
                lane, row = lane[on], row[on]
        return emitted[size, np.arange(lanes)]

    def word_counts(self, words: Words, pick: np.ndarray) -> np.ndarray:
        """Tokens of each picked white-space word, which may hold several pretokens."""
        text = b"\n".join([words.word(i) for i in pick]).decode()
        if not text.isascii():
            # white space other than ASCII also cuts, and lower case is by character
            text = regex.sub(r"[^\S\n]+", " ", unicodedata.normalize("NFC", text))
            text = text.replace("Σ", "σ").lower()
        found = self.split.findall(text)
        mark = np.fromiter((t == "\n" for t in found), dtype=bool, count=len(found))
        owner = np.cumsum(mark)[~mark]
        tokens = [t.encode() for t, m in zip(found, mark) if not m]
        size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        end = np.cumsum(size + 1) - 1
        raw = np.frombuffer(b"\n".join(tokens) + b"\n", dtype=np.uint8)
        counts = self.count_tokens(raw, end - size, end)
        return np.bincount(owner, weights=counts, minlength=len(pick)).astype(np.int64)

    def text_counts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a buffer."""
        specials = np.zeros(len(offsets) - 1, dtype=np.int64)
        data = None
        for mark in self.special:
            data = raw.tobytes() if data is None else data
            at = data.find(mark)
            if at < 0:
                continue
            raw = raw.copy() if not raw.flags.writeable else raw
            while at >= 0:
                row = np.searchsorted(offsets, at, side="right") - 1
                if at + len(mark) <= offsets[row + 1]:
                    specials[row] += 1
                    raw[at:at + len(mark)] = 32  # the text is cut here, as at a blank
                    at = data.find(mark, at + len(mark))
                else:
                    at = data.find(mark, at + 1)
        words = Words(raw, offsets)
        h, first, index = np.unique(words.hash, return_index=True, return_inverse=True)
        known, values = self.words
        at = np.searchsorted(known, h)
        hit = np.zeros(len(h), dtype=bool)
        inside = at < len(known)
        hit[inside] = known[at[inside]] == h[inside]
        counts = np.zeros(len(h), dtype=np.int64)
        counts[hit] = values[at[hit]]
        if not hit.all():
            counts[~hit] = self.word_counts(words, first[~hit])
            if len(known) + len(h) > KEEP_WORDS:
                known, values, hit = known[:0], values[:0], np.zeros(len(h), dtype=bool)
            merged = np.concatenate((known, h[~hit]))
            order = np.argsort(merged)
            self.words = (merged[order], np.concatenate((values, counts[~hit]))[order])
        # the scan: running sum of emitted counts, read off where each text begins and ends
        total = np.concatenate(([0], np.cumsum(counts[index])))
        cut = np.searchsorted(words.start, offsets)
        return total[cut[1:]] - total[cut[:-1]] + specials


_machines: dict[str, Machine] = keeps({})


def machine_of(spec: str) -> Machine:
    if spec not in _machines:
        _machines.clear()
        _machines[spec] = Machine(spec)
    return _machines[spec]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of each row of
    ``docs`` (doc_id, text). ``tokenizer`` is the path of the tokenizer's file."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    sent = docs.sparkSession.sparkContext.broadcast(spec)  # a vocabulary file's size

    def stage(batch: pa.RecordBatch):
        machine = machine_of(sent.value)
        ids, texts = batch.column(0), batch.column(1)
        for a, b in row_slices(texts):
            raw, offsets = text_buffer(texts.slice(a, b - a))
            n = machine.text_counts(raw, offsets)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), pa.array(np.diff(offsets)), pa.array(n)],
                names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    return arrow_stage(rows, stage, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
