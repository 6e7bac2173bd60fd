"""SentencePiece (BPE) encoding with seeded merge-dropout, and decoding.

Encoding follows SentencePiece's agenda: symbols start as single characters
(a space is U+2581, one is put in front of the text, characters outside the
vocabulary become byte pieces); the adjacent pair whose merge has the best
score is taken, the leftmost if tied, until none is left. Provilkov et al.,
"BPE-Dropout" (2020): with probability ``dropout`` a candidate taken from the
agenda is skipped for good. The draw is a hash of a key, the place and the merged piece, so a retried task
gives the same pieces, and every segmentation decodes to the same text. Every
chunk of every text has a key of its own, of (seed, row key, place), so another
seed, row or place gives other merges. ``dropout=0`` is SentencePiece's own encoding.

Chunks start at a run of spaces, which no piece has inside, and are cut again
where no piece spans two neighbouring characters; merges can't cross such a
place, so the parts are independent. Parts of one length are worked on together
in numpy, one agenda step of every part at a time; parts of more than ``WIDE``
characters use a heap each. A worker remembers the merges that up to ``REMEMBER``
words of up to 15 bytes make without dropout, and their pieces. An occurrence of
which none of these merges is skipped has these pieces; any other runs its own
agenda. What a worker remembers never changes a result.

Lossless: a literal U+2581 in a text goes through byte pieces, spaces are
neither trimmed nor folded, and invalid UTF-8 goes through byte pieces byte by
byte. Null text: null pieces; empty text: no pieces. An empty table gives an
empty one; other columns are passed on.
"""

from __future__ import annotations

import heapq
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .textvec import U, mix

WIDE = 32
NONE = np.int32(2**31 - 1)
SLICE = 1 << 18        # bytes of text worked on at once
SHORT = 15             # bytes of a word that can be remembered
REMEMBER = 400_000     # words a worker keeps, about 80 bytes each
DENSE = 0x400          # pairs of code points below it are looked up in a square table


class Vocabulary:
    """Tables of a BPE model with byte fallback, from the model file's bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        piece = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        byte_id = {int(piece[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(byte_id) != 256:
            raise ValueError("the model needs byte fallback")
        self.byte_id = np.array([byte_id[b] for b in range(256)], np.int32)
        by_piece = {piece[i]: i for i in normal}
        self.size = n
        # characters inside pieces that are no piece of their own get ids from n on
        extra = sorted({c for i in normal for c in piece[i]} - set(by_piece))
        symbol = {**by_piece, **{c: n + j for j, c in enumerate(extra)}}
        self.extra_cp = np.array([ord(c) for c in extra], np.int64)
        self.of_cp = np.full(0x110000, -1, np.int32)
        for s, i in symbol.items():
            if len(s) == 1:
                self.of_cp[ord(s)] = i
        self.space = int(self.of_cp[0x2581])
        self.of_cp[0x20] = self.space
        self.of_cp[0x2581] = -1
        score = np.array([sp.get_score(i) for i in range(n)])
        self.rank = np.unique(-score, return_inverse=True)[1].astype(np.int32)
        self.rank_or_none = np.append(self.rank, NONE).astype(np.int32)    # index -1: no merge
        self.span = 1 << int(n + len(extra)).bit_length()
        pairs, near = {}, set()
        for i in normal:
            s = piece[i]
            for c in range(1, len(s)):
                near.add(symbol[s[c - 1]] * self.span + symbol[s[c]])
                if s[:c] in symbol and s[c:] in symbol:
                    pairs[symbol[s[:c]] * self.span + symbol[s[c:]]] = i
        self.merges = _Table(pairs)
        self.near = _Table(dict.fromkeys(near, 1))
        low = self.of_cp[:DENSE].astype(np.int64)
        both = (low[:, None] * self.span + low[None, :]).ravel()
        near = (self.near.get(both) >= 0) & np.repeat(low >= 0, DENSE) & np.tile(low >= 0, DENSE)
        #: merge of two common characters; -1: none, but a piece holds them side by side; -2: no piece does
        self.dense = np.where(near, self.merges.get(both), np.int32(-2))
        raw = self._raw(piece, set(normal), byte_id)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.bytes_at = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)

    @staticmethod
    def _raw(piece, normal, byte_id):
        back = {i: bytes([b]) for b, i in byte_id.items()}
        return [back[i] if i in back else piece[i].replace("▁", " ").encode() if i in normal else b"" for i in range(len(piece))]


    def pairs(self, cp: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """``dense`` of each symbol and the next, for characters of any code point (U+2581 as the space)."""
        low = (cp[:-1] < DENSE) & (cp[1:] < DENSE)
        out = self.dense[np.where(low, cp[:-1] * DENSE + cp[1:], 0)]
        rest = np.flatnonzero(~low)
        if len(rest):
            a, b = sym[rest].astype(np.int64), sym[rest + 1]
            keys = a * self.span + b
            out[rest] = np.where((a >= 0) & (b >= 0) & (self.near.get(keys) >= 0), self.merges.get(keys), np.int32(-2))
        return out


class _Table:
    """Open-addressing look-up of int64 keys to int32 values over whole arrays; -1 where missing."""

    def __init__(self, entries: dict[int, int]):
        bits = max(10, len(entries).bit_length() + 3)
        self.shift, self.mask = U(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        keys = np.array(list(entries), np.int64)
        values = np.array(list(entries.values()), np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            _, one = np.unique(at[free], return_index=True)     # one key a slot and turn
            who = np.flatnonzero(free)[one]
            self.keys[at[who]] = keys[who]
            self.values[at[who]] = values[who]
            rest = np.ones(len(keys), bool)
            rest[who] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys):
        return ((keys.astype(U) * U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], np.int32(-1))
        todo = np.flatnonzero((found != keys) & (found != -1))
        at = at[todo]
        while len(todo):
            at = (at + 1) & self.mask
            found = self.keys[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            go = ~hit & (found != -1)
            todo, at = todo[go], at[go]
        return out


def code_points(buf: np.ndarray):
    """(code points, byte index of each) of valid UTF-8."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[at].astype(np.int32)
    cp = lead.copy()
    n = len(buf)
    for size, low, high, keep in ((2, 0xC0, 0xE0, 0x1F), (3, 0xE0, 0xF0, 0x0F), (4, 0xF0, 0xF8, 0x07)):
        pick = np.flatnonzero((lead >= low) & (lead < high))
        if not len(pick):
            continue
        value = lead[pick] & keep
        for d in range(1, size):
            value = (value << 6) | (buf[np.minimum(at[pick] + d, n - 1)] & 0x3F).astype(np.int32)
        cp[pick] = value
    return cp, at


def _skips(key: np.ndarray, place: np.ndarray, piece: np.ndarray, dropout: float) -> np.ndarray:
    draw = mix(key + place.astype(U) * U(0xD1342543DE82EF95) + piece.astype(U) * U(0xC2B2AE3D27D4EB4F))
    return draw < U(min(2**64 - 1, int(dropout * 2.0**64)))


def _agenda(v: Vocabulary, sym: np.ndarray, first: np.ndarray, key: np.ndarray, place: np.ndarray, dropout: float,
            log: list | None = None) -> np.ndarray:
    """Merge parts of one length: ``sym`` [n, L] of symbols becomes pieces at their first symbol's column, -1 elsewhere.

    ``first`` [n, L - 1]: the merges of neighbouring characters. Flat tables with W = L + 1 columns hold, at a live symbol's cell, the symbol, the piece and rank of its merge
    with the next live symbol, and links to its neighbours; column L is the end of the part.
    ``log`` takes (row, column, piece) of the merges.
    """
    n, width = sym.shape
    w = width + 1
    out = np.empty_like(sym)
    end = np.full((n, 1), -1, np.int32)
    piece = np.full((n, w), -1, np.int32)
    piece[:, :width - 1] = first
    prio = v.rank_or_none[piece]
    sym = np.concatenate([sym, end], axis=1)
    cell = np.arange(n * w, dtype=np.int64).reshape(n, w)
    nxt, prv = cell + 1, cell - 1
    prv[:, 0] = width                              # before the first symbol: the end, whose symbol is -1
    prv[:, 0] += cell[:, 0]
    which = np.arange(n)
    sym, piece, nxt, prv = sym.ravel(), piece.ravel(), nxt.ravel(), prv.ravel()
    while True:
        col = prio.argmin(axis=1)
        base = np.arange(len(which)) * w
        at = base + col
        flat = prio.ravel()
        live = flat[at] != NONE
        alive = int(np.count_nonzero(live))
        if alive < len(which):
            if alive * 2 < len(which):             # go on with the live rows only
                out[which] = sym.reshape(-1, w)[:, :width]
                keep = np.flatnonzero(live)
                if not len(keep):
                    return out
                move = (np.arange(len(keep)) - keep)[:, None] * w
                nxt = (nxt.reshape(-1, w)[keep] + move).ravel()
                prv = (prv.reshape(-1, w)[keep] + move).ravel()
                sym, piece, prio = sym.reshape(-1, w)[keep].ravel(), piece.reshape(-1, w)[keep].ravel(), prio[keep]
                which, key, place = which[keep], key[keep], place[keep]
                continue
            at, rows = at[live], np.flatnonzero(live)
        else:
            rows = None
        new = piece[at]
        if dropout > 0:
            c = col if rows is None else col[rows]
            k, q = (key, place) if rows is None else (key[rows], place[rows])
            skip = _skips(k, q + c, new, dropout)
            if skip.any():
                flat[at[skip]] = NONE
                go = ~skip
                at, new = at[go], new[go]
                if not len(at):
                    continue
        if log is not None:
            log.append((which[at // w], at % w, new))
        right = nxt[at]
        after = nxt[right]
        before = prv[at]
        sym[at] = new
        sym[right] = -1
        flat[right] = NONE
        nxt[at] = after
        prv[after] = at
        wide = new.astype(np.int64)
        for cells, left, mate in ((at, wide, sym[after]), (before, sym[before].astype(np.int64), new)):
            got = v.merges.get(left * v.span + mate)   # an end's -1 makes a key that no table has
            piece[cells] = got
            flat[cells] = v.rank_or_none[got]


def _heap(v: Vocabulary, symbols: np.ndarray, key, place: int, dropout: float, log: list | None = None) -> np.ndarray:
    """The same agenda for one long part; ``log`` takes (column, piece) of the merges."""
    n = len(symbols)
    sym = symbols.tolist()
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []
    one = np.zeros(1, np.int64)

    def offer(i, k):
        if i < 0 or k >= n:
            return
        one[0] = sym[i] * v.span + sym[k]
        p = int(v.merges.get(one)[0])
        if p >= 0:
            heapq.heappush(heap, (int(v.rank[p]), i, p, sym[i], sym[k]))
    first = v.merges.get(symbols[:-1].astype(np.int64) * v.span + symbols[1:])
    for i in np.flatnonzero(first >= 0).tolist():
        p = int(first[i])
        heap.append((int(v.rank[p]), i, p, sym[i], sym[i + 1]))
    heapq.heapify(heap)
    while heap:
        _, i, p, a, b = heapq.heappop(heap)
        k = nxt[i] if sym[i] == a else n
        if k >= n or sym[k] != b:
            continue                                   # a neighbour has merged meanwhile
        if dropout > 0 and _skips(np.array([key], U), np.array([place + i]), np.array([p]), dropout)[0]:
            continue
        if log is not None:
            log.append((i, p))
        sym[i], sym[k] = p, -1
        nxt[i] = nxt[k]
        if nxt[k] < n:
            prv[nxt[k]] = i
        offer(prv[i], i)
        offer(i, nxt[i])
    return np.array(sym, np.int32)


def encode_rows(v: Vocabulary, buf: np.ndarray, off: np.ndarray, key: np.ndarray, dropout: float, pad_empty: bool = False,
                log: list | None = None):
    """(ids, counts): the pieces of every row, one after the other; ``key``: uint64 of each row.

    ``log`` takes (row, place, piece) of the merges.

    Works on every character; ``Encoder`` calls it for the chunks it doesn't remember. Rows without text have
    no pieces, or the space in front alone with ``pad_empty``.
    """
    n = len(off) - 1
    cp, at = code_points(buf)
    row_first = np.searchsorted(at, off)
    solid = np.arange(n) if pad_empty else np.flatnonzero(np.diff(off) > 0)
    # one space in front of each row that isn't empty
    cp = np.insert(cp, row_first[solid], 0x20)
    sym = v.of_cp[cp]
    byte_at = np.insert(at, row_first[solid], off[solid])
    has = np.zeros(n, bool)
    has[solid] = True
    added = np.cumsum(has)
    starts = row_first + np.concatenate([[0], added])
    row = np.repeat(np.arange(n), np.diff(starts))
    m = len(sym)
    if not m:
        return np.zeros(0, np.int32), np.zeros(n, np.int64)
    pair = v.pairs(cp, sym)
    joined = np.zeros(m, bool)                         # may a piece hold this symbol and the one before
    joined[1:] = pair >= -1
    joined[starts[:-1][solid]] = False
    part = np.flatnonzero(~joined)
    length = np.diff(np.append(part, m))
    out = sym.copy()
    for width in np.unique(length):
        if width == 1:
            continue
        pick = part[length == width]
        if width > WIDE:
            for p in pick.tolist():
                made = None if log is None else []
                out[p:p + width] = _heap(v, sym[p:p + width], key[row[p]], p - int(starts[row[p]]), dropout, made)
                if made:
                    c, merged = np.array(made, np.int64).T
                    log.append((np.full(len(c), row[p]), p - starts[row[p]] + c, merged))
            continue
        step = max(1, (1 << 16) // int(width))
        for i in range(0, len(pick), step):
            p = pick[i:i + step]
            cells = p[:, None] + np.arange(width)[None, :]
            made = None if log is None else []
            out[cells] = _agenda(v, sym[cells], pair[cells[:, :-1]], key[row[p]], p - starts[row[p]], dropout, made)
            if made:
                log.extend((row[p[r]], p[r] - starts[row[p[r]]] + c, m) for r, c, m in made)
    # characters outside the vocabulary, and inner characters that are no piece, become bytes
    raw = (sym < 0) | (out >= v.size)
    size = np.ones(m, np.int64)
    size[(out < 0) & ~raw] = 0
    if raw.any():
        ends = np.append(byte_at[1:], len(buf))
        size[raw] = (ends - byte_at)[raw]
    total = np.concatenate([[0], np.cumsum(size)])
    ids = np.empty(int(total[-1]), np.int32)
    plain = (size == 1) & ~raw
    ids[total[:-1][plain]] = out[plain]
    which = np.flatnonzero(raw)
    if len(which):
        rep = np.repeat(np.arange(len(which)), size[which])
        inner = np.arange(len(rep)) - np.repeat(np.cumsum(size[which]) - size[which], size[which])
        ids[total[which][rep] + inner] = v.byte_id[buf[byte_at[which][rep] + inner]]
    return ids, total[starts[1:]] - total[starts[:-1]]


class Encoder:
    """Encodes rows of valid UTF-8, remembering the pieces of short words."""

    def __init__(self, v: Vocabulary, seed: int, dropout: float):
        self.v, self.dropout = v, dropout
        self.salt = U(tv._mix_int(seed))
        bits = (2 * REMEMBER).bit_length()
        self.mask, self.shift = (1 << bits) - 1, U(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.words = np.zeros((REMEMBER, 2), U)
        self.at = np.zeros(REMEMBER + 1, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)     # remembered pieces, then those of the rows at work
        self.merge_at = np.zeros(REMEMBER + 1, np.int64)
        self.merges = np.zeros((0, 2), np.int32)   # (place, piece) of the remembered words' merges
        self.n = self.kept = self.used = 0

    def _find(self, word: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Entry of each (two-number) word, or -1."""
        slot = (h >> self.shift).astype(np.int64)
        got = self.slots[slot]
        todo = np.flatnonzero((got >= 0) & (self.words[got] != word).any(axis=1))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.mask
            e = self.slots[slot]
            got[todo] = e
            go = (e >= 0) & (self.words[e] != word[todo]).any(axis=1)
            todo, slot = todo[go], slot[go]
        return got

    def _put(self, ids: np.ndarray) -> int:
        """Where ``ids`` now lie behind those in use."""
        at = self.used
        if at + len(ids) > len(self.ids):
            more = np.zeros(max(2 * len(self.ids), at + len(ids)), np.int32)
            more[:at] = self.ids[:at]
            self.ids = more
        self.ids[at:at + len(ids)] = ids
        self.used = at + len(ids)
        return at

    def _keep(self, word: np.ndarray, h: np.ndarray, counts: np.ndarray, merges: np.ndarray, n_merges: np.ndarray) -> None:
        """Remember these words' pieces and merges, the first ones behind those kept so far, as far as there is room."""
        m = min(len(word), len(self.words) - self.n)
        if m <= 0:
            return
        word, h, counts, n_merges = word[:m], h[:m], counts[:m], n_merges[:m]
        self.words[self.n:self.n + m] = word
        self.at[self.n + 1:self.n + m + 1] = self.at[self.n] + np.cumsum(counts)
        self.kept += int(counts.sum())
        have, more = int(self.merge_at[self.n]), int(n_merges.sum())
        if have + more > len(self.merges):
            room = np.zeros((max(2 * len(self.merges), have + more), 2), np.int32)
            room[:have] = self.merges[:have]
            self.merges = room
        self.merges[have:have + more] = merges[:more]
        self.merge_at[self.n + 1:self.n + m + 1] = have + np.cumsum(n_merges)
        entry = np.arange(self.n, self.n + m, dtype=np.int32)
        slot = (h >> self.shift).astype(np.int64)
        while len(entry):
            free = np.flatnonzero(self.slots[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            who = free[one]
            self.slots[slot[who]] = entry[who]
            rest = np.ones(len(entry), bool)
            rest[who] = False
            entry, slot = entry[rest], (slot[rest] + 1) & self.mask
        self.n += m

    def rows(self, buf: np.ndarray, off: np.ndarray, row_key: np.ndarray):
        """(ids, counts) of every row; ``row_key``: int64 of each row."""
        n, size = len(off) - 1, len(buf)
        if not size:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        solid = np.flatnonzero(np.diff(off) > 0)
        space = buf == 0x20
        opens = space.copy()                      # a run of spaces opens a chunk
        opens[1:] &= ~space[:-1]
        opens[off[:-1][solid]] = False            # a row's own chunk opens with the space in front
        inner = np.flatnonzero(opens)
        begin = np.concatenate([off[:-1][solid], inner + 1])
        order = np.argsort(begin, kind="stable")
        begin = begin[order]
        row = np.searchsorted(off, np.minimum(begin, size - 1), side="right") - 1
        # a chunk behind a row's last space has no bytes and begins where the next row does
        late = np.concatenate([np.zeros(len(solid), bool), np.ones(len(inner), bool)])[order]
        behind = late & (np.isin(begin, off))
        row[behind] = np.searchsorted(off, begin[behind] - 1, side="right") - 1
        swap = np.lexsort((begin, row))
        begin, row, late = begin[swap], row[swap], late[swap]
        last = np.append(row[1:] != row[:-1], True)
        end = np.empty_like(begin)
        end[:-1] = begin[1:] - 1
        end[last] = off[row[last] + 1]
        length = end - begin
        key = mix(mix(row_key.astype(U) ^ self.salt)[row] + (begin - off[row]).astype(U))
        short = (length > 0) & (length <= SHORT)
        short[short] = ~space[begin[short]]       # no second space in front
        literal = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x96) & (buf[2:] == 0x81)) if size > 2 else []
        if len(literal):
            short[np.searchsorted(begin, literal, side="right") - 1] = False
        at, counts = np.empty(len(begin), np.int64), np.empty(len(begin), np.int64)
        self.used = self.kept
        pick = np.flatnonzero(short)
        if len(pick):
            at[pick], counts[pick], dropped = self._short(buf, begin[pick], length[pick], key[pick])
            short[pick[dropped]] = False
        pick = np.flatnonzero(~short)
        if len(pick):
            ids, c = self._chunks(buf, begin[pick], length[pick], key[pick])
            counts[pick] = c
            at[pick] = self._put(ids) + np.cumsum(c) - c
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.arange(int(total[-1])) + np.repeat(at - total[:-1], counts)]
        per_row = np.bincount(row, weights=counts, minlength=n).astype(np.int64)
        return ids, per_row

    def _chunks(self, buf, begin, length, key, dropout=None, log=None):
        ends = np.concatenate([[0], np.cumsum(length)])
        data = buf[np.arange(int(ends[-1])) + np.repeat(begin - ends[:-1], length)]
        return encode_rows(self.v, data, ends, key, self.dropout if dropout is None else dropout, pad_empty=True, log=log)

    def _short(self, buf, begin, length, key):
        """(start, count) of each word's pieces without dropout in ``ids``, and whether it skips one of their merges."""
        cells = begin[:, None] + np.arange(SHORT)[None, :]
        data = np.zeros((len(begin), SHORT + 1), np.uint8)
        data[:, :SHORT] = buf[np.minimum(cells, len(buf) - 1)]
        data[:, :SHORT][np.arange(SHORT)[None, :] >= length[:, None]] = 0
        data[:, SHORT] = length
        word = data.view(U)
        h = mix(word[:, 0] ^ mix(word[:, 1] ^ self.salt))
        got = self._find(word, h)
        new = np.flatnonzero(got < 0)
        start, count, dropped = np.empty(len(begin), np.int64), np.empty(len(begin), np.int64), np.zeros(len(begin), bool)
        if len(new):
            order = np.argsort(h[new], kind="stable")
            w = word[new[order]]
            head = np.ones(len(new), bool)
            head[1:] = (w[1:] != w[:-1]).any(axis=1)     # equal words stand together; a hash shared by others is harmless
            back = np.empty(len(new), np.int64)
            back[order] = np.cumsum(head) - 1
            one = new[order[head]]
            log = [] if self.dropout > 0 else None
            ids, c = self._chunks(buf, begin[one], length[one], h[one], 0.0, log)
            at = self._put(ids)
            made, n_made = np.zeros((0, 2), np.int32), np.zeros(len(one), np.int64)
            if log:
                word_no, place, piece = (np.concatenate(x) for x in zip(*log, strict=True))
                by_word = np.argsort(word_no, kind="stable")
                made = np.stack([place, piece], axis=1).astype(np.int32)[by_word]
                n_made = np.bincount(word_no, minlength=len(one))
            start[new], count[new] = (at + np.cumsum(c) - c)[back], c[back]
            dropped[new] = self._skipped(key[new], made, (np.cumsum(n_made) - n_made)[back], n_made[back])
        old = np.flatnonzero(got >= 0)
        e = got[old]
        start[old], count[old] = self.at[e], self.at[e + 1] - self.at[e]
        dropped[old] = self._skipped(key[old], self.merges, self.merge_at[e], self.merge_at[e + 1] - self.merge_at[e])
        if len(new):
            self._keep(word[one], h[one], c, made, n_made)
        return start, count, dropped

    def _skipped(self, key, merges, first, n) -> np.ndarray:
        """Whether any of the ``n`` merges from ``first`` on is skipped under each key."""
        out = np.zeros(len(key), bool)
        if self.dropout > 0 and len(key):
            who = np.repeat(np.arange(len(key)), n)
            m = merges[np.arange(len(who)) + np.repeat(first - (np.cumsum(n) - n), n)]
            out[who[_skips(key[who], m[:, 0], m[:, 1], self.dropout)]] = True
        return out


def decode_rows(v, ids: np.ndarray, counts: np.ndarray):
    """(bytes, offsets) of the texts of rows of pieces; the space put in front is taken off."""
    size = np.diff(v.bytes_at)[ids]
    first = np.concatenate([[0], np.cumsum(size)])
    src = np.arange(int(first[-1])) - np.repeat(first[:-1] - v.bytes_at[ids], size)
    data = v.bytes[src]
    ends = first[np.concatenate([[0], np.cumsum(counts)])]
    lens = np.diff(ends)
    keep = np.ones(len(data), bool)
    keep[ends[:-1][lens > 0]] = False
    return data[keep], np.concatenate([[0], np.cumsum(lens - (lens > 0))])


_LOADED: dict[tuple, object] = {}


def _once(key: tuple, make):
    """What ``make`` gives, made once a worker for the latest key of its kind."""
    if _LOADED.get((key[0], "key")) != key:
        _LOADED[key[0], "key"], _LOADED[key[0]] = key, make()
    return _LOADED[key[0]]


def _vocabulary(model: bytes) -> Vocabulary:
    return _once(("vocabulary", model), lambda: Vocabulary(model))


def _encoder(model: bytes, seed: int, dropout: float) -> Encoder:
    return _once(("encoder", model, seed, dropout), lambda: Encoder(_vocabulary(model), seed, dropout))


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def _valid(buf: np.ndarray) -> bool:
    try:
        buf.tobytes().decode("utf-8")
        return True
    except UnicodeDecodeError:
        return False


def encode(docs: DataFrame, model: bytes, text_col: str = "text", key_col: str = "doc_id", out_col: str = "pieces",
           seed: int = 17, dropout: float = 0.1, check_col: str | None = None) -> DataFrame:
    """``docs`` with an array of piece ids; ``key_col`` (a long, null as 0) makes the draws of each row its own.

    ``check_col``, if given, tells whether the pieces, decoded again in the same task, are the text.
    ``model`` (the bytes of a model file, about 0.5 MB) is broadcast.
    """
    if not 0 <= dropout <= 1:
        raise ValueError("dropout is a probability")
    held = docs.sparkSession.sparkContext.broadcast(model)
    t, k = docs.columns.index(text_col), docs.columns.index(key_col)
    added = [T.StructField(out_col, T.ArrayType(T.IntegerType()))]
    if check_col:
        added.append(T.StructField(check_col, T.BooleanType()))
    schema = T.StructType([*docs.schema.fields, *added])
    names = [f.name for f in schema.fields]

    def run(batches):
        enc = _encoder(held.value, seed, dropout)
        for b in batches:
            text = b.column(t)
            buf, off = tv.utf8(text)
            null = text.is_null().to_numpy(zero_copy_only=False)
            key = b.column(k).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in tv.slices(off, SLICE):
                part, at = buf[off[i]:off[j]], off[i:j + 1] - off[i]
                ids, counts = (enc.rows if _valid(part) else partial(_by_row, enc))(part, at, key[i:j])
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                cols = [pa.ListArray.from_arrays(pa.array(ends), pa.array(ids), mask=pa.array(null[i:j]))]
                if check_col:
                    cols.append(pa.array(_same(*decode_rows(enc.v, ids, counts), part, at)))
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, *cols], names=names)
    return docs.mapInArrow(tv.lean(run), schema)


def _same(data, off, want, want_off) -> np.ndarray:
    """Whether each row's bytes are the wanted ones."""
    if len(data) == len(want) and (off == want_off).all() and (data == want).all():
        return np.ones(len(off) - 1, bool)
    return np.array([np.array_equal(data[off[i]:off[i + 1]], want[want_off[i]:want_off[i + 1]]) for i in range(len(off) - 1)])


def _by_row(enc: Encoder, buf, off, key):
    """Rows one by one; a row of invalid UTF-8 is all bytes, behind the space in front."""
    ids, counts = [], []
    for i in range(len(off) - 1):
        part = buf[off[i]:off[i + 1]]
        if _valid(part):
            got = enc.rows(part, np.array([0, len(part)]), key[i:i + 1])[0]
        else:
            got = np.concatenate([enc.v.byte_id[[0x20]], enc.v.byte_id[part]])
        ids.append(got)
        counts.append(len(got))
    return np.concatenate(ids), np.array(counts, np.int64)


def _text(v, ids, counts, validity=None) -> pa.Array:
    data, off = decode_rows(v, ids, counts)
    return pa.StringArray.from_buffers(len(counts), pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)), validity)


def decode(encoded: DataFrame, model: bytes, pieces_col: str = "pieces", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each row's pieces. Unknown ids raise; null pieces give null."""
    held = encoded.sparkSession.sparkContext.broadcast(model)
    p = encoded.columns.index(pieces_col)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches):
        v = _vocabulary(held.value)
        for b in batches:
            col = b.column(p)
            counts = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(counts)])
            for i, j in tv.slices(at, SLICE // 4):
                text = _text(v, ids[at[i]:at[j]], counts[i:j], _validity(col.slice(i, j - i)))
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns, text], names=[*b.schema.names, out_col])
    return encoded.mapInArrow(tv.lean(run), schema)


def _validity(col):
    """Validity bitmap of an array, or None if nothing is null."""
    if not col.null_count:
        return None
    bits = np.packbits(~col.is_null().to_numpy(zero_copy_only=False), bitorder="little")
    return pa.py_buffer(bits)
