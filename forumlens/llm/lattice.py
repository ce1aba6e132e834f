"""Piece lattices over an existing SentencePiece vocabulary.

The vocabulary file gives pieces and scores.  A unit is a space (or none)
and what follows it up to the next space, or a single newline: no piece of
the vocabulary crosses such a border (checked when it is loaded), so the
lattice of a text is the chain of its units' lattices, and each distinct unit
is built once per batch.

All lattices of a batch are built at once: the trie of pieces is walked from
every position in step, and the forward sums run over the positions of all
units together, in log space.

A character without a piece is spelled with byte pieces, so is a literal
U+2581, which is why decoding gives back every text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece

from forumlens.llm import textbytes as tb

SPACE = 0x2581               # the vocabulary's mark for a space
LITERAL = 0x110000           # stands for a U+2581 of the text: matches no piece
UNUSED_SCORE = -1e8          # pieces below are never produced by the vocabulary


class Vocabulary:
    """Pieces, scores and the trie of a SentencePiece model file."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.size = n
        self.score = np.array([sp.get_score(i) for i in range(n)])
        self.byte_id = np.full(256, -1, np.int64)
        raw, usable = [], []
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                raw.append(bytes([int(p[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                raw.append(p.replace("▁", " ").encode())
                if self.score[i] > UNUSED_SCORE:
                    if "▁" in p[1:] or "\n" in p:
                        raise ValueError(f"piece {p!r} crosses a unit border")
                    usable.append((p, i))
        if (self.byte_id < 0).any():
            raise ValueError("the vocabulary has no byte pieces")
        self.usable = np.array([i for _, i in usable])
        self.raw_offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self._trie(usable)

    def _trie(self, usable) -> None:
        child, self.piece_of = {}, [-1]
        for p, i in usable:
            s = 0
            for c in map(ord, p):
                key = (s << 21) | c
                if key not in child:
                    child[key] = len(self.piece_of)
                    self.piece_of.append(-1)
                s = child[key]
            self.piece_of[s] = i
        self.piece_of = np.array(self.piece_of, np.int64)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        to = np.fromiter(child.values(), np.int64, len(child))
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.to = np.full(1 << self.bits, -1, np.int64)
        slot = self._slot(keys)
        while len(keys):                      # linear probing, all keys in step
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = first[free[first]]
            self.keys[slot[put]], self.to[slot[put]] = keys[put], to[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, to = keys[rest], to[rest]
            slot = (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        with np.errstate(over="ignore"):
            return (tb.mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, state, char):
        """Next trie state of each (state, character), -1 if there is none."""
        key = (state << 21) | char
        slot = self._slot(key)
        have = self.keys[slot]
        out = np.where(have == key, self.to[slot], -1)
        open_ = np.flatnonzero((have != key) & (have >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            have = self.keys[slot[open_]]
            hit = have == key[open_]
            out[open_[hit]] = self.to[slot[open_[hit]]]
            open_ = open_[~hit & (have >= 0)]
        return out

    def rank_weights(self) -> np.ndarray:
        """Natural-log probability of each piece from the file's scores alone.
        Scores that are log probabilities are used as they are; a merge
        vocabulary's score is minus the merge rank, taken as Zipf's law:
        1 / (1 + rank).  Byte pieces get the weight of the rarest piece."""
        w = np.full(self.size, -np.inf)
        s = self.score[self.usable]
        w[self.usable] = s if s.min() > -100 else -np.log1p(-s)
        w[self.byte_id] = w[self.usable].min()
        top = w.max()
        return w - (top + np.log(np.exp(w - top).sum()))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the concatenated pieces."""
        lo, hi = self.raw_offsets[ids], self.raw_offsets[ids + 1]
        size = hi - lo
        at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        return self.raw[at + np.repeat(lo, size)]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def units(data: np.ndarray, off: np.ndarray):
    """Cut rows into units.  Returns (dictionary of distinct units, unit of
    each occurrence, first occurrence of each row)."""
    start = np.zeros(len(data), bool)
    if len(data):
        start[:] = (data == 0x20) | (data == 0x0A)
        start[1:] |= data[:-1] == 0x0A
        start[off[:-1][off[:-1] < off[1:]]] = True
    pos = np.flatnonzero(start)
    enc = tb.binary_array(data, np.append(pos, len(data))).dictionary_encode()
    return (enc.dictionary, enc.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            np.searchsorted(pos, off))


class Lattice:
    """Lattices of many strings.  Node ``first[s] + k`` is string s before
    its k-th character; an edge spells ``piece`` (or, if -1, the bytes of the
    character at its start)."""

    def __init__(self, vocab: Vocabulary, strings: pa.Array, space_prefix: bool = False):
        """``strings``: large_binary UTF-8, none empty; ``space_prefix`` puts
        the vocabulary's space mark before each."""
        data, off = tb.values_buffer(strings)
        lead = (data & 0xC0) != 0x80
        n = (np.add.reduceat(lead, off[:-1]).astype(np.int64) if len(strings)
             else np.empty(0, np.int64))
        cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
        nbytes = np.where(cp < 0x80, 1, np.where(cp < 0x800, 2, np.where(cp < 0x10000, 3, 4)))
        self.bytes, self.byte_at = data, np.cumsum(nbytes) - nbytes
        cp = np.where(cp == SPACE, LITERAL, np.where(cp == 0x20, SPACE, cp))
        if space_prefix:
            at = np.cumsum(n) - n
            cp = np.insert(cp, at, SPACE)
            nbytes = np.insert(nbytes, at, 0)
            self.byte_at = np.insert(self.byte_at, at, 0)
            n = n + 1
        self.nbytes, self.vocab = nbytes, vocab
        m = len(cp)
        begin = np.cumsum(n) - n
        local = (np.arange(m) - np.repeat(begin, n)).astype(np.int32)
        left = np.repeat(n.astype(np.int32), n) - local
        node = (np.arange(m) + np.repeat(np.arange(len(n)), n)).astype(np.int32)
        self.first, self.last = begin + np.arange(len(n)), begin + np.arange(len(n)) + n
        at, state, length = np.arange(m, dtype=np.int32), np.zeros(m, np.int64), 0
        starts, sizes, pieces = [], [], []
        single = np.zeros(m, bool)
        while len(at):
            state = vocab.step(state, cp[at + length])
            length += 1
            on = state >= 0
            at, state = at[on], state[on]
            p = vocab.piece_of[state]
            hit = p >= 0
            starts.append(at[hit])
            sizes.append(np.full(int(hit.sum()), length, np.int32))
            pieces.append(p[hit])
            if length == 1:
                single[at[hit]] = True
            on = left[at] > length
            at, state = at[on], state[on]
        bare = np.flatnonzero(~single)
        starts.append(bare)
        sizes.append(np.ones(len(bare), np.int32))
        pieces.append(np.full(len(bare), -1))
        start = np.concatenate(starts).astype(np.int32)
        dst = node[start] + np.concatenate(sizes).astype(np.int32)
        order = np.argsort(dst, kind="stable")          # a few sorted runs
        start = start[order]
        self.char = start                               # flat character index
        self.piece = np.concatenate(pieces).astype(np.int32)[order]
        self.src, self.dst = node[start], dst[order]
        local = local[start]
        small = np.int16 if len(local) and local.max() < 32767 else np.int32
        self.order = np.argsort(local.astype(small), kind="stable").astype(np.int32)
        self.steps = np.concatenate([[0], np.flatnonzero(np.diff(local[self.order])) + 1,
                                     [len(local)]])
        self.nodes = m + len(n)

    def edge_weights(self, logp: np.ndarray) -> np.ndarray:
        """``logp`` of each edge; a spelled character is its bytes' sum."""
        w = logp[np.maximum(self.piece, 0)]
        bare = np.flatnonzero(self.piece < 0)
        c = self.char[bare]
        total = np.zeros(len(bare))
        for k in range(4):
            on = self.nbytes[c] > k
            total[on] += logp[self.vocab.byte_id[self.bytes[self.byte_at[c[on]] + k]]]
        # the mark put before a string has no bytes of its own
        total[self.nbytes[c] == 0] = logp[self.vocab.byte_id[0x20]]
        w[bare] = total
        return w

    def forward(self, w: np.ndarray) -> np.ndarray:
        """Log sum over all paths to each node."""
        a = np.full(self.nodes, -np.inf)
        a[self.first] = 0.0
        dst, src, w = self.dst[self.order], self.src[self.order], w[self.order]
        for lo, hi in zip(self.steps[:-1], self.steps[1:]):
            to = dst[lo:hi]                             # each node once per step
            a[to] = np.logaddexp(a[to], a[src[lo:hi]] + w[lo:hi])
        return a

    def marginal(self, logp: np.ndarray) -> np.ndarray:
        """Log probability of each string, over all its segmentations."""
        return self.forward(self.edge_weights(logp))[self.last]


class Sampler:
    """Backward sampling from the filtered lattices."""

    def __init__(self, lattice: Lattice, logp: np.ndarray):
        w = lattice.edge_weights(logp)
        a = lattice.forward(w)
        self.dst, self.src = lattice.dst, lattice.src
        self.piece, self.char = lattice.piece, lattice.char
        total = np.cumsum(np.exp(a[self.src] + w - a[self.dst]))
        self.hi = np.cumsum(np.bincount(self.dst, minlength=lattice.nodes)).astype(np.int32)
        self.lo = np.append(np.int32(0), self.hi[:-1])
        base = np.concatenate([[0.0], total])[self.lo]
        self.cum = total - base[self.dst]
        self.lattice = lattice

    def sample(self, string: np.ndarray, seed: np.ndarray):
        """Segment the string of every occurrence; ``seed`` is a uint64 per
        occurrence.  Returns (piece ids, first id of each occurrence)."""
        lat = self.lattice
        n = len(string)
        live, node = np.arange(n), lat.last[string]
        steps, count, k = [], np.zeros(n, np.int64), 0
        with np.errstate(over="ignore"):
            while len(live):
                k += 1
                u = (tb.mix(seed[live] + np.uint64(k) * tb._BASE) >> np.uint64(11)) * 2.0 ** -53
                e, last = self.lo[node].copy(), self.hi[node] - 1
                on = np.flatnonzero((u >= self.cum[e]) & (e < last))
                while len(on):
                    e[on] += 1
                    on = on[(u[on] >= self.cum[e[on]]) & (e[on] < last[on])]
                size = np.where(self.piece[e] >= 0, 1, np.maximum(lat.nbytes[self.char[e]], 1))
                steps.append((live, e, size))
                count[live] += size
                node = self.src[e]
                on = node > lat.first[string[live]]
                live, node = live[on], node[on]
        first = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(int(first[-1]), np.int32)
        end = first[1:].copy()
        for who, e, size in steps:                     # from the end backwards
            end[who] -= size
            piece = self.piece[e]
            whole = piece >= 0
            out[end[who[whole]]] = piece[whole]
            c, at = self.char[e[~whole]], end[who[~whole]]
            for b in range(4):
                on = lat.nbytes[c] > b
                out[at[on] + b] = lat.vocab.byte_id[lat.bytes[lat.byte_at[c[on]] + b]]
        return out, first
