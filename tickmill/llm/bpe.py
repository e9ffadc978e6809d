"""Byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation works on arrays of code points. Each code point becomes a
symbol (letter, number, white space before white space, ...; the only
look-ahead is in the symbol), each symbol is a transition function on eight
states, and the functions are composed by a blocked associative scan: their
closure under composition is a small monoid whose table is computed once, so a
scan step is one table lookup for all blocks together. The state before a
symbol tells whether a piece begins there. The slices feed a cached pair
merger; byte offsets are kept, so ids decode to the exact bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

L, N, O, A2, A3, P, W, T, R = range(9)
sL, sN, sO, sP, sT, sW, c2, c3 = range(8)
#: Code points of the White_Space property (fixed values).
SPACES = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CACHE = 1 << 19
SHORT = 32
_BLOCK = 256


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a piece begins at the symbol)."""
    if symbol in (A2, A3) and state in (sO, sP):
        symbol = O  # the apostrophe belongs to the run before it
    if symbol == L:
        if state in (c2, c3):
            return (c2 if state == c3 else sW), False
        return sL, state not in (sL, sP)
    if symbol == N:
        return sN, state not in (sN, sP)
    if symbol == O:
        return sO, state not in (sO, sP)
    if symbol == T:
        return sT, state != sT
    return {A2: c2, A3: c3, P: sP, W: sW, R: sW}[symbol], True


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element of each symbol, composition table, images): the closure of the symbols' functions."""
    gens = [tuple(_step(s, y)[0] for s in range(8)) for y in range(9)]
    elements = {tuple(range(8)): 0}
    queue = [tuple(range(8))]
    for f in queue:
        for g in gens:
            h = tuple(g[s] for s in f)
            if h not in elements:
                elements[h] = len(elements)
                queue.append(h)
    table = np.array([[elements[tuple(g[s] for s in f)] for g in queue] for f in queue])
    kind = np.uint8 if len(queue) <= 256 else np.uint16
    return np.array([elements[g] for g in gens], kind), table.astype(kind), np.array(queue, np.uint8)


_ELEMENT, _COMPOSE, _IMAGE = _monoid()
_FLAT, _WIDE = _COMPOSE.reshape(-1), np.uint16(len(_COMPOSE))
_BEGINS = np.array([[_step(s, y)[1] for y in range(9)] for s in range(8)])
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    """L, N, O or T of every code point."""
    if not _classes:
        first = {"L": L, "N": N}
        t = np.fromiter((first.get(unicodedata.category(chr(c))[0], O) for c in range(0x110000)), np.uint8, 0x110000)
        t[list(SPACES)] = T
        _classes.append(t)
    return _classes[0]


def states_before(symbols: np.ndarray) -> np.ndarray:
    """The automaton's state before each symbol, by a scan over blocks and one over the blocks' totals."""
    n = len(symbols)
    blocks = -(-n // _BLOCK)
    f = np.zeros(blocks * _BLOCK, _ELEMENT.dtype)  # 0: identity
    f[:n] = _ELEMENT[symbols]
    f = np.ascontiguousarray(f.reshape(blocks, _BLOCK).T)
    for j in range(1, _BLOCK):
        np.take(_FLAT, f[j - 1] * _WIDE + f[j], out=f[j], mode="clip")
    before = np.zeros(blocks, f.dtype)
    totals, step = f[-1].copy(), 1
    while step < blocks:  # doubling over blocks
        totals[step:] = _COMPOSE[totals[:-step], totals[step:]]
        step *= 2
    before[1:] = totals[:-1]
    after = _IMAGE[_COMPOSE[before[None, :], f], sW].T.reshape(-1)[:n]
    return np.r_[np.uint8(sW), after[:-1]] if n else after


def pieces(parts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """(bytes, piece starts and ends in them, first piece of each part and the total); parts are joined by NUL separators that belong to no piece."""
    text = b"\0".join(parts).decode("utf-8", "surrogatepass")
    raw = text.encode("utf-8", "surrogatepass") + b"\0"
    cp = np.frombuffer((text + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    at = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    part_at = np.cumsum([0, *(len(p) + 1 for p in parts)])  # in bytes
    sep = np.searchsorted(at, part_at[1:] - 1)  # code point index of each part's separator
    k = classes()[cp]
    k[sep] = R
    nxt = np.r_[k[1:], np.uint8(R)]
    symbols = k.copy()
    white = k == T
    last = white & (nxt != T) & (nxt != R)
    symbols[last] = np.where(cp[last] == 32, P, W)
    quote = np.flatnonzero((cp == 39) & (k == O) & (nxt == L))
    if len(quote):
        c = np.r_[cp, np.zeros(2, np.uint32)]
        one, two = c[quote + 1], c[quote + 2]
        symbols[quote[np.isin(one, [ord(x) for x in "stmd"])]] = A2
        pair = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            pair |= (one == ord(a)) & (two == ord(b))
        symbols[quote[pair]] = A3
    begin = _BEGINS[states_before(symbols), symbols]
    begin[sep] = True
    edges = np.flatnonzero(begin)
    real = symbols[edges] != R
    starts = at[edges[real]]
    ends = at[np.r_[edges[1:], len(cp)][real]]
    return raw, starts, ends, np.searchsorted(starts, part_at)


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Merger(dict):
    """Ids of a piece by merging its lowest-ranked adjacent pair again and again, leftmost first; results are cached, and the cache is emptied when full."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.pairs = Pairs(ranks)

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        found = self[piece] = self.merge(piece)
        return found

    def merge(self, piece: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        if piece in ranks:
            return (ranks[piece],)
        n = len(piece)
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends; 0 once it is merged away
        left = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            if not end[i] or end[i] >= n or end[end[i]] != e:
                continue  # one of the parts has changed since
            gone = end[i]
            end[i], end[gone] = e, 0
            if e < n:
                left[e] = i
                if (r := ranks.get(piece[i : end[e]])) is not None:
                    heapq.heappush(heap, (r, i, end[e]))
            if (p := left[i]) >= 0 and (r := ranks.get(piece[p:e])) is not None:
                heapq.heappush(heap, (r, p, e))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)


    def learn(self, slices: list[bytes]) -> None:
        """Caches the short pieces of a batch that are not cached yet, merged side by side: a round merges one pair of every piece."""
        missing = [x for x in set(slices).difference(self) if len(x) <= SHORT]
        if len(self) + len(missing) > CACHE:
            self.clear()
            missing = [x for x in set(slices) if len(x) <= SHORT]
        missing.sort(key=len)
        for i in range(0, len(missing), 4096):
            part = missing[i : i + 4096]
            self.update(zip(part, self.pairs.merge(part)))


class Pairs:
    """Ranks of all adjacent token pairs whose bytes together are a token, in an open-addressing table."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        key, value = np.array(keys, np.uint64), np.array(values, np.int32)
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask = size - 1
        self.key, self.value = np.full(size, common._M64, np.uint64), np.full(size, self.NONE, np.int32)
        left, step = np.arange(len(key)), 0
        while len(left):
            slot = (self._slot(key[left]) + step) & self.mask
            slot, first = np.unique(np.where(self.key[slot] == np.uint64(common._M64), slot, -1), return_index=True)
            first = first[slot >= 0]
            slot = slot[slot >= 0]
            self.key[slot], self.value[slot] = key[left[first]], value[left[first]]
            left = np.delete(left, first)
            step += 1
        self.steps = step

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(common._P)) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)
        slot = self._slot(key)
        out = np.where(self.key[slot] == key, self.value[slot], self.NONE)
        open_ = np.flatnonzero((out == self.NONE) & (self.key[slot] != np.uint64(common._M64)))
        for step in range(1, self.steps):
            if not len(open_):
                break
            at = (slot[open_] + step) & self.mask
            hit = self.key[at] == key[open_]
            out[open_[hit]] = self.value[at[hit]]
            open_ = open_[~hit & (self.key[at] != np.uint64(common._M64))]
        return out

    def merge(self, part: list[bytes]) -> list[tuple[int, ...]]:
        n, width = len(part), max(map(len, part), default=1)
        size = np.fromiter(map(len, part), np.int64, n)
        grid = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in part), np.uint8).reshape(n, width)
        ids = self.single[grid]
        col = np.arange(width)
        rank = np.full((n, width), self.NONE, np.int32)
        if width > 1:
            r, c = np.nonzero(col[None, 1:] < size[:, None])
            rank[r, c] = self.rank(ids[r, c], ids[r, c + 1])
        after, before, dead, last = np.arange(1, n * width + 1), np.arange(-1, n * width - 1), np.zeros(n * width, bool), n * width - 1
        flat_ids, flat_rank = ids.reshape(-1), rank.reshape(-1)
        live, at = np.arange(n), rank.argmin(1)
        while len(live):
            best = flat_rank[live * width + at]
            more = best != self.NONE
            live, at, best = live[more], at[more], best[more]
            if not len(live):
                break
            # the merged id goes where the pair's second was; its first becomes a hole that the links skip
            i = live * width + at
            j = after[i]
            flat_ids[i] = best
            k = after[j]
            after[i], before[np.minimum(k, last)] = k, np.where(k < (live + 1) * width, i, before[np.minimum(k, last)])
            flat_rank[j], dead[j] = self.NONE, True
            flat_rank[i] = self.NONE
            has = k < live * width + size[live]
            flat_rank[i[has]] = self.rank(best[has], flat_ids[k[has]])
            has = at > 0
            h = before[i[has]]
            flat_rank[h] = self.rank(flat_ids[h], best[has])
            at = rank[live].argmin(1)
        keep = ~dead & (np.tile(col, n) < np.repeat(size, width))
        count = np.add.reduceat(keep, np.arange(0, n * width, width)) if n else np.empty(0, int)
        out, ends = flat_ids[keep].tolist(), np.cumsum(count).tolist()
        return [tuple(out[i:j]) for i, j in zip([0, *ends], ends)]


class Codec:
    def __init__(self, ranks: dict[bytes, int]):
        self.merger = Merger(ranks)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.text_of = {i: b"%d" % i for i in ranks.values()}

    def encode_batch(self, parts: list[bytes]) -> list[tuple[list[int], np.ndarray, np.ndarray]]:
        """(ids, piece starts as byte offsets in the part) for each part."""
        raw, starts, ends, first = pieces(parts)
        slices = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        self.merger.learn(slices)
        of = list(map(self.merger.__getitem__, slices))
        at = np.cumsum([0, *(len(p) + 1 for p in parts)])
        return [(list(chain.from_iterable(of[i:j])), starts[i:j] - o) for i, j, o in zip(first[:-1].tolist(), first[1:].tolist(), at[:-1].tolist())]

    def encode(self, text: bytes) -> list[int]:
        return self.encode_batch([text])[0][0]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_codecs: dict[int, Codec] = {}
common.kept_in_worker.append(_codecs)


def codec(shared) -> Codec:
    """The codec of broadcast rank-file bytes, made once in each worker."""
    key = hash(shared.value)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(shared.value))
    return _codecs[key]


def encode(docs: DataFrame, ranks_path: str, ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids array<int> (if asked for), ids_sha256, decoded_sha256 and round_trip of every row.

    Null and empty texts have no tokens. Nothing but doc_id and text is read, so
    other columns may have any name. Repeated rows give repeated results.
    """
    sc = docs.sparkSession.sparkContext
    with open(ranks_path, "rb") as f:
        shared = sc.broadcast(f.read())  # a vocabulary file: its size doesn't depend on the data

    def run(batches):
        made = codec(shared)
        for batch in batches:
            raw, doc_ids = common.texts(batch), batch.column("doc_id")
            for i, j in common.groups([len(x) for x in raw], 1 << 20):
                rows = []
                for text, (tokens, _) in zip(raw[i:j], made.encode_batch(raw[i:j])):
                    back = made.decode(tokens)
                    row = (len(tokens), hashlib.sha256(b" ".join(map(made.text_of.__getitem__, tokens))).hexdigest(), hashlib.sha256(back).hexdigest(), back == text)
                    rows.append((*row, tokens) if ids else row)
                yield pa.RecordBatch.from_arrays([doc_ids[i:j], *(pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32()))))], names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", *["ids"] * ids]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * ids)


def op3(spark, sf_dir):
    """Token ids of every whole text, as counts and digests, and the digest of what they decode to.

    Null and empty texts have no tokens. Rows of equal or null doc_id have a row each. Ties: of equal ranks the leftmost pair merges
    first. An empty table gives no rows. Other columns are not read.
    """
    import public_tokenizers

    return encode(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), ids=False).drop("round_trip")
