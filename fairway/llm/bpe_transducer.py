"""A byte-level BPE tokenizer compiled to deterministic transducers.

Two transducers replace the tokenizer library:

* *Splitter.* The pre-tokenizer's pattern (contractions, letters, digits, other
  marks, white space) as a table over 11 states and 13 byte classes whose
  transitions say where a piece begins. The text is cut into chunks; the map
  from every possible entry state to the exit state is computed for all chunks
  at once, the maps are composed by a parallel prefix scan, and a second pass
  from the now known entry states emits the borders. Most chunk maps become
  constant after a few bytes, from where one state is followed instead of 11.
* *Merger.* Within a piece, position ``i`` is reached by exactly one last token
  ``t``: the one vocabulary entry ending there that may follow the last token
  at ``i - len(t)``. Two tokens may stand side by side when undoing merges from
  the latest back never meets a cheaper merge across their border. So the
  merger reads left to right with the last tokens of the window as its state,
  and each transition is annotated with the tokens emitted so far. It runs over
  all new pieces of a slice together; pieces met before come from a bounded
  index by 64-bit hash.

The result equals the library's: ids, hence counts, of
``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``; added
special strings inside a text become their one token.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np

from fairway.llm.textvec import U64, HashIndex, RangeHash, Texts, entries_inside, mix

# byte classes; +_N marks the first byte of a text
_L, _STMD, _R, _V, _E, _EL, _NUM, _SP, _WS, _AP, _OTHER, _CONT, _N = range(13)
# splitter states
START, LETTER, DIGIT, MARK, BLANK, SPACE_, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, DONE = range(11)
STATES = 11
#: White space of the pattern: Unicode's White_Space property (fixed values).
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters and numbers (first, last) of Unicode 16.0, the library's version,
#: that 15.1 does not have; Python's own tables may be of either version.
_ADDED_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
_ADDED_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
                  (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
CHUNK = 256
INDEX_ENTRIES = 1 << 20
_NEVER = 1 << 30


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emitted borders) by state * 26 + class. Border bits: 1
    before this character, 2 before the one read last."""
    letters = {_L, _STMD, _R, _V, _E, _EL}

    def fresh(c):
        return (LETTER if c in letters else {_NUM: DIGIT, _SP: BLANK, _WS: SPACE_, _AP: QUOTE}.get(c, MARK)), 1

    def step(s, c):
        if c == _CONT:
            return s, 0
        if s == LETTER and c in letters:
            return LETTER, 0
        if s == DIGIT and c == _NUM:
            return DIGIT, 0
        if s == MARK and c in (_OTHER, _AP):
            return MARK, 0
        if s in (BLANK, SPACE_):
            if c in (_SP, _WS):
                return (BLANK if c == _SP else SPACE_), 0
            if s == BLANK:  # the last blank joins what follows
                return (LETTER if c in letters else DIGIT if c == _NUM else MARK), 2
            return fresh(c)[0], 3
        if s == QUOTE:
            if c == _STMD:
                return DONE, 0
            if c in (_R, _V, _EL):
                return {_R: QUOTE_R, _V: QUOTE_V, _EL: QUOTE_L}[c], 0
            if c in (_OTHER, _AP):
                return MARK, 0
        if s in (QUOTE_R, QUOTE_V, QUOTE_L):
            if c == (_EL if s == QUOTE_L else _E):
                return DONE, 0
            return (LETTER, 2) if c in letters else (fresh(c)[0], 3)
        return fresh(c)

    go, emit = np.zeros(STATES * 26, np.uint16), np.zeros(STATES * 26, np.uint8)
    for s in range(STATES):
        for c in range(_N):
            go[s * 26 + c], emit[s * 26 + c] = step(s, c)
            # first byte of a text: whatever came before has ended
            go[s * 26 + _N + c], e = fresh(c)
            emit[s * 26 + _N + c] = e | (2 if s in (QUOTE_R, QUOTE_V, QUOTE_L) else 0)
    return go, emit


def _class_of(cp: int) -> int:
    if cp in _WHITE_SET:
        return _SP if cp == 32 else _WS
    kind = _ADDED.get(cp) or unicodedata.category(chr(cp))[0]
    if kind == "L":
        return {"s": _STMD, "t": _STMD, "m": _STMD, "d": _STMD, "r": _R, "v": _V, "e": _E, "l": _EL}.get(chr(cp), _L)
    return _NUM if kind == "N" else _AP if cp == 39 else _OTHER


_WHITE_SET = set(_WHITE)
_ADDED = {cp: kind for kind, ranges in (("L", _ADDED_LETTERS), ("N", _ADDED_NUMBERS))
          for first, last in ranges for cp in range(first, last + 1)}


class Transducers:
    """Compiled from a byte-level BPE ``tokenizer.json``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"] or \
                spec["model"]["type"] != "BPE":
            raise ValueError("only byte-level BPE without prefix space or normaliser is compiled")
        self.special = {a["content"].encode(): a["id"] for a in spec["added_tokens"]}
        byte_of = self._byte_alphabet()
        vocab = spec["model"]["vocab"]
        raw = {t: bytes(byte_of[ch] for ch in t) for t in vocab if t not in {a["content"] for a in spec["added_tokens"]}}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        n = max(vocab.values()) + 1
        self.length = np.zeros(n + 1, np.int32)
        self.rank = np.full(n, -1, np.int64)
        self.left, self.right = np.zeros(n, np.int32), np.zeros(n, np.int32)
        keys, ranks = [], []
        for rank, (a, b) in enumerate(merges):
            i = vocab[a + b]
            keys.append(vocab[a] << 20 | vocab[b])
            ranks.append(rank)
            if self.rank[i] < 0:
                self.rank[i], self.left[i], self.right[i] = rank, vocab[a], vocab[b]
        self._pairs = HashIndex(1 << 17)
        self._pairs.insert(mix(np.array(keys, dtype=U64)))
        self._pair_rank = np.array(ranks, dtype=np.int64)
        ids = np.array([vocab[t] for t in raw], np.int32)
        self.length[ids] = [len(b) for b in raw.values()]
        self.longest = int(self.length.max())
        data = np.frombuffer(b"".join(raw.values()), np.uint8)
        ends = np.cumsum([len(b) for b in raw.values()])
        self._tokens = HashIndex(1 << 17)
        self._tokens.insert(RangeHash(data)(np.concatenate([[0], ends[:-1]]), ends))
        self._token_ids = ids
        self._go, self._emit = _splitter()
        self._ascii = np.array([_class_of(i) if i < 128 else _CONT for i in range(256)], np.uint8)
        self._classes: dict[int, int] = {}
        self._reset()

    @staticmethod
    def _byte_alphabet() -> dict[str, int]:
        """Printable Latin-1 characters stand for their own byte, the other
        bytes in order for the characters from 256 on."""
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        other = [b for b in range(256) if b not in own]
        return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}

    def _reset(self) -> None:
        self._index = HashIndex(INDEX_ENTRIES)
        self._counts = np.zeros(0, np.int32)
        self._ids: list[np.ndarray] = []
        self._id_flat, self._id_at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    # ---------------------------------------------------------------- splitter
    def _byte_classes(self, data: np.ndarray) -> np.ndarray:
        cls = self._ascii[data]
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            b = np.zeros((4, len(lead)), np.int64)
            for j in range(4):
                b[j] = data[np.minimum(lead + j, len(data) - 1)]
            cp = np.where(b[0] < 0xE0, (b[0] & 31) << 6 | b[1] & 63, np.where(
                b[0] < 0xF0, (b[0] & 15) << 12 | (b[1] & 63) << 6 | b[2] & 63,
                (b[0] & 7) << 18 | (b[1] & 63) << 12 | (b[2] & 63) << 6 | b[3] & 63))
            seen, inverse = np.unique(cp, return_inverse=True)
            for c in seen:
                if int(c) not in self._classes:
                    self._classes[int(c)] = _class_of(int(c))
            cls[lead] = np.array([self._classes[int(c)] for c in seen], np.uint8)[inverse]
        return cls

    def _borders(self, cls: np.ndarray) -> np.ndarray:
        """Emitted border bits by byte: chunk maps, prefix scan, emission."""
        n = len(cls)
        chunks = -(-n // CHUNK)
        grid = np.full(chunks * CHUNK, _CONT, np.uint8)
        grid[:n] = cls
        grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T).astype(np.uint16)
        go, head = self._go, min(24, CHUNK)
        maps = np.repeat(np.arange(STATES, dtype=np.uint16)[:, None], chunks, 1)
        for t in range(head):
            maps = go[maps * np.uint16(26) + grid[t]]
        one = (maps == maps[0]).all(axis=0)
        several, single = maps[:, ~one], maps[0, one]
        rest_several, rest_single = grid[head:, ~one], grid[head:, one]
        for t in range(CHUNK - head):
            single = go[single * np.uint16(26) + rest_single[t]]
            if several.size:
                several = go[several * np.uint16(26) + rest_several[t]]
        maps[:, one], maps[:, ~one] = single, several
        # parallel prefix scan: after round k a map spans 2 ** k chunks
        d = 1
        while d < chunks:
            later = np.take_along_axis(maps[:, d:], maps[:, :-d].astype(np.int64), axis=0)
            maps = np.concatenate([maps[:, :d], later], axis=1)
            d *= 2
        state = np.concatenate([[START], maps[START, :-1]]).astype(np.uint16)
        out = np.empty((CHUNK, chunks), np.uint8)
        for t in range(CHUNK):
            code = state * np.uint16(26) + grid[t]
            out[t] = self._emit[code]
            state = go[code]
        return out.T.reshape(-1)[:n]

    def pieces(self, data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
        """Starts of all pieces, and the id of pieces that are special strings."""
        n = len(data)
        special: dict[int, int] = {}
        first = np.zeros(n + 1, bool)
        first[text_starts] = True
        if n and self.special:
            raw = data.tobytes()
            for s, i in self.special.items():
                at = raw.find(s)
                while at >= 0:
                    if not first[at + 1:at + len(s)].any():
                        special[at] = i
                        first[at] = first[at + len(s)] = True
                        at = raw.find(s, at + len(s))
                    else:
                        at = raw.find(s, at + 1)
        if n == 0:
            return np.zeros(0, np.int64), special
        cls = np.append(self._byte_classes(data), np.uint8(_L))
        first[n] = True  # one more byte ends the last text
        cls[first] += _N
        bits = self._borders(cls)
        border = (bits & 1).astype(bool)
        back = np.flatnonzero(bits & 2) - 1
        while len(wrong := np.flatnonzero(cls[np.maximum(back, 0)] == _CONT)):
            back[wrong] -= 1
        border[back[back >= 0]] = True
        for at, i in special.items():
            size = next(len(s) for s, j in self.special.items() if j == i and data[at:at + len(s)].tobytes() == s)
            border[at + 1:at + size] = False
        return np.flatnonzero(border[:n]), special

    # ------------------------------------------------------------------ merger
    def _may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether token ``b`` may stand after token ``a``."""
        ok = np.ones(len(a), bool)
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), _NEVER)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            number = self._pairs.lookup(mix((x << 20 | y).astype(U64)))
            cost = np.where(number >= 0, self._pair_rank[number], _NEVER)
            bad = cost < limit[live]
            ok[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~bad & ((rx >= 0) | (ry >= 0))
            undo_x = rx > ry
            a[live] = np.where(undo_x, self.right[x], x)
            b[live] = np.where(~undo_x & (ry >= 0), self.left[y], y)
            limit[live] = np.where(undo_x, rx, ry + 1)
            live = live[on]
        return ok

    def _merge(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list]:
        """Token count and ids (flat, with offsets) of each piece."""
        size = ends - starts
        m = len(starts)
        base = np.concatenate([[0], np.cumsum(size + 1)])
        last = np.full(int(base[-1]), -1, np.int32)   # last token at each position
        count = np.zeros(int(base[-1]), np.int32)     # tokens emitted up to it
        # vocabulary entries that end at each position, longest first
        piece, pos, length, token = entries_inside(data, starts, ends, self._tokens, self._token_ids, self.longest)
        group = np.flatnonzero(np.concatenate([[True], (pos[1:] != pos[:-1]) | (piece[1:] != piece[:-1])]))
        group_end = np.append(group[1:], len(pos))
        level = np.searchsorted(pos[group], np.arange(1, int(size.max(initial=0)) + 2))
        for i in range(len(level) - 1):
            cursor, end = group[level[i]:level[i + 1]].copy(), group_end[level[i]:level[i + 1]]
            live = np.arange(len(cursor))
            while len(live):
                c = cursor[live]
                here = base[piece[c]]
                before = here + pos[c] - length[c]
                ok = (pos[c] == length[c]).copy()
                inner = np.flatnonzero(~ok)
                inner = inner[last[before[inner]] >= 0]
                ok[inner] = self._may_follow(last[before[inner]], token[c[inner]])
                got = c[ok]
                last[here[ok] + pos[got]] = token[got]
                count[here[ok] + pos[got]] = count[before[ok]] + 1
                live = live[~ok]
                cursor[live] += 1
                live = live[cursor[live] < end[live]]
        counts = count[base[:-1] + size]
        # ids, from the last token back
        ids_at = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        ids = np.zeros(int(ids_at[-1]), np.int32)
        place, back = size.copy(), ids_at[1:] - 1
        live = np.arange(m)
        while len(live):
            t = last[base[live] + place[live]]
            ids[back[live]] = t
            back[live] -= 1
            place[live] -= self.length[t]
            live = live[place[live] > 0]
        return counts, [ids, ids_at]

    def encode(self, texts: Texts, with_ids: bool = False):
        """For every piece of ``texts``: start, row, token count; with ids also
        the flat ids of all pieces in order."""
        if self._index.full:
            self._reset()
        starts, special = self.pieces(texts.data, texts.starts[texts.ends > texts.starts])
        ends = np.append(starts[1:], len(texts.data))
        row = texts.row_of(starts)
        hashes = RangeHash(texts.data)(starts, ends) if len(starts) else np.zeros(0, U64)
        number = self._index.lookup(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh, first = np.unique(hashes[new], return_index=True)
            s, e = starts[new[first]], ends[new[first]]
            counts, ids = self._merge(texts.data, s, e)
            for at, i in special.items():  # a special string is one token
                k = np.flatnonzero(s == at)
                if len(k):
                    a = ids[1]
                    j = int(k[0])
                    ids[0] = np.concatenate([ids[0][:a[j]], [i], ids[0][a[j + 1]:]]).astype(np.int32)
                    ids[1] = np.concatenate([a[:j + 1], a[j + 1:] - (counts[j] - 1)])
                    counts[j] = 1
            self._index.insert(fresh)
            self._counts = np.concatenate([self._counts, counts])
            self._id_at = np.concatenate([self._id_at, self._id_at[-1] + ids[1][1:]])
            self._id_flat = np.concatenate([self._id_flat, ids[0]])
            number[new] = self._index.lookup(hashes[new])
        n = self._counts[number]
        if not with_ids:
            return starts, row, n
        total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        flat = np.arange(int(total[-1])) + np.repeat(self._id_at[number] - total[:-1], n)
        return starts, row, n, self._id_flat[flat]


_compiled: dict[str, Transducers] = {}


def transducers(name: str) -> Transducers:
    """Compiled once in each Python worker from the public vocabulary file."""
    if name not in _compiled:
        import public_tokenizers

        _compiled[name] = Transducers(public_tokenizers.path(name))
    return _compiled[name]
