"""Unigram segmentation lattices over a fixed public piece vocabulary.

A word is spelled as a space and its bytes. Its probability is the sum, over all ways to
cut it into pieces, of the product of the piece probabilities: the forward recursion
``alpha[j] = logsum over pieces spelled i..j of alpha[i] + log p(piece)``, run in log space
for many words at a time (words are lanes, positions are steps, the piece trie supplies
the arcs). Every byte is a piece, so every text has a segmentation.

A word longer than ``CUT`` bytes is a lane of its own, taken in runs of that many bytes; the
last values of a run, as many as the longest piece has bytes, are carried into the next, so
that all segmentations of the word are summed and memory stays bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lateflow.llm.shared import keeps
from lateflow.llm.words import U64, Words

CUT = 4096
CELLS = 1 << 18
#: word values kept from slice to slice in a Python worker; cleared beyond this
KEEP = 1 << 18


def load_pieces(path: str) -> list[bytes]:
    """The distinct spellings of a sentencepiece model's pieces, best score first, with
    all 256 single bytes (its byte fallback). A leading space marks a word's start."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    found = []
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            spelled = model.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in spelled[1:]:
                found.append((-model.get_score(i), spelled))
    found = [s for _, s in sorted(found)] + [bytes([b]) for b in range(256)]
    return list(dict.fromkeys(found))


class Trie:
    """Pieces as a byte trie. The children of each node that has some are one stretch of a
    table, from its least to its greatest byte."""

    def __init__(self, pieces: list[bytes]):
        children: list[dict[int, int]] = [{}]
        piece_of = [-1]
        for number, spelled in enumerate(pieces):
            node = 0
            for b in spelled:
                nxt = children[node].get(b)
                if nxt is None:
                    nxt = len(children)
                    children.append({})
                    piece_of.append(-1)
                    children[node][b] = nxt
                node = nxt
            piece_of[node] = number
        self.depth = max(map(len, pieces), default=1)
        self.piece = np.array(piece_of, dtype=np.int32)
        inner = [i for i, c in enumerate(children) if c]
        self.row = np.zeros(len(children), dtype=np.int32)  # 0: no children
        self.row[inner] = np.arange(1, len(inner) + 1)
        low = np.array([min(children[i]) for i in inner], dtype=np.int64)
        span = np.array([max(children[i]) for i in inner], dtype=np.int64) - low + 1
        # 256 places on either side, so that every byte of every row falls into the table
        self.base = np.zeros(len(inner) + 1, dtype=np.int32)
        self.base[1:] = np.cumsum(span) - span - low + 256
        size = int(span.sum()) + 512
        self.owner, self.child = np.full(size, -1, np.int32), np.zeros(size, np.int32)
        for at, i in enumerate(inner, 1):
            for b, node in children[i].items():
                spot = self.base[at] + b
                self.owner[spot], self.child[spot] = at, node

    def step(self, row: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes that the rows' nodes reach by these bytes, 0 if none."""
        at = self.base[row] + byte
        return np.where(self.owner[at] == row, self.child[at], 0)


_tries: dict[tuple, Trie] = keeps({})


def trie_of(pieces: list[bytes]) -> Trie:
    key = (len(pieces), hash(tuple(pieces)))
    if key not in _tries:
        _tries.clear()
        _tries[key] = Trie(pieces)
    return _tries[key]


def _split(words: Words, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``pick`` of the words up to CUT bytes, and of the longer ones."""
    long = words.end[pick] - words.start[pick] > CUT
    return np.flatnonzero(~long), np.flatnonzero(long)


def _lanes(words: Words, pick: np.ndarray):
    """Blocks of (owner, byte matrix [position, lane], lengths), longest lanes first."""
    start = words.start[pick]
    size = words.end[pick] - start + 1
    order = np.argsort(-size, kind="stable")
    at = 0
    while at < len(order):
        longest = int(size[order[at]])
        block = order[at:at + max(1, CELLS // (longest + 1))]
        spots = start[block][None, :] + np.arange(longest)[:, None] - 1
        bytes_ = words.lower[np.clip(spots, 0, len(words.lower) - 1)]
        bytes_[0] = 32
        yield block, bytes_, size[block]
        at += len(block)


def _spelled(trie: Trie, data: np.ndarray, first: int, last: int) -> np.ndarray:
    """[position, d]: the piece spelled by the d + 1 bytes from each position, or -1."""
    out = np.full((last - first, trie.depth), -1, dtype=np.int32)
    at, row = np.arange(first, last), np.ones(last - first, dtype=np.int32)
    for d in range(trie.depth):
        inside = at + d < len(data)
        at, row = at[inside], row[inside]
        node = trie.step(row, data[at + d])
        at, node = at[node > 0], node[node > 0]
        out[at - first, d] = trie.piece[node]
        row = trie.row[node]
        at, row = at[row > 0], row[row > 0]
        if not len(at):
            break
    return out


def _long_word(words: Words, i: int) -> np.ndarray:
    return np.concatenate(([np.uint8(32)], words.lower[words.start[i]:words.end[i]]))


def _long_forward(trie: Trie, logp: np.ndarray, data: np.ndarray, keep: np.ndarray | None = None):
    """[model] log probability of a long word. ``keep`` takes the values at all positions
    (of one model)."""
    depth, table = trie.depth, np.vstack((logp, np.full((1, logp.shape[1]), -np.inf)))
    tail = np.full((depth, logp.shape[1]), -np.inf)
    tail[-1] = 0.0
    if keep is not None:
        keep[0] = 0.0
    back = np.arange(depth)
    for first in range(0, len(data), CUT):
        last = min(first + CUT, len(data))
        low = max(0, first - depth + 1)
        spelled = _spelled(trie, data, low, last)
        start = np.arange(first, last)[:, None] - back  # of the piece of d + 1 bytes that ends here
        arcs = np.where(start >= low, spelled[np.maximum(start - low, 0), back], -1)
        weight = table[arcs]
        alpha = np.concatenate((tail, np.empty((last - first, logp.shape[1]))))
        for j in range(last - first):
            x = alpha[j:j + depth][::-1] + weight[j]
            top = x.max(axis=0)
            alpha[depth + j] = top + np.log(np.exp(x - top).sum(axis=0))
        if keep is not None:
            keep[first + 1:last + 1] = alpha[depth:, 0]
        tail = alpha[-depth:]
    return tail[-1]


def _long_counts(trie: Trie, logp: np.ndarray, data: np.ndarray, times: float) -> np.ndarray:
    """Expected uses of each piece in a long word that occurs ``times`` times."""
    n, depth = len(data), trie.depth
    alpha = np.empty(n + 1)
    total = _long_forward(trie, logp, data, alpha)[0]
    beta = np.full(n + depth + 1, -np.inf)
    beta[n] = 0.0
    table, out = np.append(logp[:, 0], -np.inf), np.zeros(len(logp))
    for first in reversed(range(0, n, CUT)):
        last = min(first + CUT, n)
        spelled = _spelled(trie, data, first, last)
        weight = table[spelled]
        for i in range(last - 1, first - 1, -1):
            x = weight[i - first] + beta[i + 1:i + 1 + depth]
            top = x.max()
            beta[i] = top + np.log(np.exp(x - top).sum())
        ends = np.arange(first, last)[:, None] + 1 + np.arange(depth)
        use = np.exp(np.minimum(alpha[first:last, None] + weight + beta[ends] - total, 0.0)) * times
        some = spelled >= 0
        out += np.bincount(spelled[some], weights=use[some], minlength=len(out))
    return out


def _forward(trie: Trie, logp: np.ndarray, bytes_: np.ndarray, length: np.ndarray,
             keep_arcs: bool = False):
    """alpha [position, lane, model] and, if asked for, the arcs (i, j, lanes, pieces)."""
    longest, lanes = bytes_.shape
    alpha = np.full((longest + 1, lanes, logp.shape[1]), -np.inf)
    alpha[0] = 0.0
    arcs = []
    for i in range(longest):
        live = int(np.searchsorted(-length, -i, side="left"))  # lanes longer than i
        lane = np.flatnonzero(alpha[i, :live, 0] > -np.inf)
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
                to, what = lane[ends], piece[ends]
                alpha[j, to] = np.logaddexp(alpha[j, to], alpha[i, to] + logp[what])
                if keep_arcs:
                    arcs.append((i, j, to, what))
            row = trie.row[node]
            on = (row > 0) & (length[lane] > j)
            lane, row = lane[on], row[on]
    return alpha, arcs


def word_logp(trie: Trie, logp: np.ndarray, words: Words, pick: np.ndarray) -> np.ndarray:
    """[word, model] natural log probability of each picked word, over all segmentations."""
    out = np.zeros((len(pick), logp.shape[1]))
    short, long = _split(words, pick)
    for owner, bytes_, length in _lanes(words, pick[short]):
        alpha, _ = _forward(trie, logp, bytes_, length)
        out[short[owner]] = alpha[length, np.arange(len(length))]
    for i in long:
        out[i] = _long_forward(trie, logp, _long_word(words, pick[i]))
    return out


def expected_counts(trie: Trie, logp: np.ndarray, words: Words, counts: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece (forward-backward), word k taken counts[k]
    times; ``logp`` has one model."""
    out = np.zeros(len(logp))
    short, long = _split(words, np.arange(len(words)))
    for i in long:
        out += _long_counts(trie, logp, _long_word(words, i), counts[i])
    for owner, bytes_, length in _lanes(words, short):
        alpha, arcs = _forward(trie, logp, bytes_, length, keep_arcs=True)
        lanes = np.arange(len(length))
        total = alpha[length, lanes, 0]
        beta = np.full(alpha.shape[:2], -np.inf)
        beta[length, lanes] = 0.0
        times = counts[short[owner]]
        for i, j, lane, piece in reversed(arcs):
            tail = logp[piece, 0] + beta[j, lane]
            beta[i, lane] = np.logaddexp(beta[i, lane], tail)
            use = np.exp(np.minimum(alpha[i, lane, 0] + tail - total[lane], 0.0)) * times[lane]
            out += np.bincount(piece, weights=use, minlength=len(out))
    return out


def first_weights(n: int) -> np.ndarray:
    """Log probabilities that fall with the rank of a piece in the vocabulary's scores."""
    p = 1.0 / (np.arange(n) + 100.0)
    return np.log(p / p.sum())


def smoothed(counts: np.ndarray, extra: float = 0.0, prior: float = 0.1) -> np.ndarray:
    """Log probabilities of pieces from expected counts; ``extra`` more events share the
    total mass (a document's end)."""
    return np.log((counts + prior) / (counts.sum() + prior * len(counts) + extra))


_seen: dict[str, tuple[np.ndarray, np.ndarray]] = keeps({})


def distinct_logp(key: str, trie: Trie, logp: np.ndarray, words: Words):
    """(values, index): log probabilities of the distinct words of a slice, and the row of
    each word. Values of earlier slices are looked up; ``key`` names the model."""
    h, first, index = np.unique(words.hash, return_index=True, return_inverse=True)
    known, values = _seen.get(key, (np.zeros(0, U64), np.zeros((0, logp.shape[1]))))
    out = np.empty((len(h), logp.shape[1]))
    at = np.searchsorted(known, h)
    hit = np.zeros(len(h), dtype=bool)
    inside = at < len(known)
    hit[inside] = known[at[inside]] == h[inside]
    out[hit] = values[at[hit]]
    if not hit.all():
        out[~hit] = word_logp(trie, logp, words, first[~hit])
        if len(known) + len(h) > KEEP:
            known, values = known[:0], values[:0]
            hit = np.zeros(len(h), dtype=bool)
        merged = np.concatenate((known, h[~hit]))
        order = np.argsort(merged)
        _seen.clear()
        _seen[key] = (merged[order], np.concatenate((values, out[~hit]))[order])
    return out, index


def word_rows(column: pa.Array) -> Words:
    """A column that holds one word in each row."""
    from lateflow.llm.words import text_buffer

    words = Words(*text_buffer(column))
    assert len(words) == len(column)
    return words
