"""A piece vocabulary and its suffix-array matching, shared by operators 2 and 9.

The vocabulary is read on the driver from a public model file whose path is
a parameter; its few ten thousand pieces go to the tasks in the closure.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Vocabularies above this size are refused: they are shipped to every task.
MAX_PIECES = 1_000_000


@dataclass
class Pieces:
    """Normal pieces (text -> id), scores by id, ids of the 256 byte pieces."""

    text: list[str]
    score: np.ndarray
    normal: np.ndarray
    byte_id: np.ndarray
    longest: int = field(default=0)

    def __post_init__(self) -> None:
        self.longest = max((len(t) for t, n in zip(self.text, self.normal) if n), default=1)
        kept = [i for i, n in enumerate(self.normal) if n]
        self.normal_ids = np.array(kept, np.int64)
        self.lengths = np.array([len(self.text[i]) for i in kept], np.int64)
        self.points = np.zeros((len(kept), self.longest), np.int64)
        for row, i in zip(self.points, kept):
            row[:len(self.text[i])] = list(map(ord, self.text[i]))
        self.ids = {t: i for i, (t, n) in enumerate(zip(self.text, self.normal)) if n}
        # merge priority: 0 is the best score; equal scores share one
        self.priority = np.unique(-self.score, return_inverse=True)[1].astype(np.int64)


def load_pieces(path: str = MODEL) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    if n > MAX_PIECES:
        raise ValueError(f"{n} pieces; at most {MAX_PIECES} are shipped")
    text = [sp.id_to_piece(i) for i in range(n)]
    normal = np.array([not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)) for i in range(n)])
    byte_id = np.full(256, sp.unk_id(), np.int64)
    for i in range(n):
        if sp.is_byte(i):
            byte_id[int(text[i][3:-1], 16)] = i
    return Pieces(text, np.array([sp.get_score(i) for i in range(n)]), normal, byte_id)


def _bisect(keys: list[np.ndarray], order: np.ndarray, wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search of many key tuples at once in the sorted suffixes."""
    lo, hi = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(order), np.int64)
    for _ in range(int(len(order)).bit_length() + 1):
        mid = (lo + hi) >> 1
        at = order[np.minimum(mid, len(order) - 1)]
        less, equal = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for k, w in zip(keys, wanted):
            v = k[at]
            less |= equal & (v < w)
            equal &= v == w
        right = (less | equal if after else less) & (lo < hi)
        lo, hi = np.where(right, mid + 1, lo), np.where(right, hi, mid)
    return lo


def _sorted_by(keys: list[np.ndarray]) -> np.ndarray:
    """Order by several keys: ranks of the last key refine those before it."""
    rank = None
    for key in reversed(keys):
        order = np.argsort(key)
        steps = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        own = np.empty(len(key), np.int64)
        own[order] = steps
        if rank is not None:
            both = (own << 32) | rank
            order = np.argsort(both)
            own = np.empty(len(key), np.int64)
            own[order] = np.concatenate(([0], np.cumsum(np.diff(both[order]) != 0)))
        rank = own
    return order


class Index:
    """All occurrences of all pieces in a list of strings.

    The strings are concatenated, a terminator after each; a suffix array is
    sorted as far as the longest piece reaches; every piece is binary-searched for its range of
    occurrences; the resulting edges are sorted by (position, length) into
    ``edge[position, length]``, which holds piece id + 1, or 0.
    """

    def __init__(self, strings: list[str], pieces: Pieces):
        joined = "\0".join(strings) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.size = np.fromiter(map(len, strings), np.int64, len(strings))
        self.start = np.concatenate(([0], np.cumsum(self.size + 1)[:-1])).astype(np.int64)
        self.points = points
        n, longest = len(points), pieces.longest
        # dense codes of the characters at hand; 0: terminator, or no such character
        table = np.zeros(0x110000, np.uint64)
        table[points] = 1
        table[0] = 0
        symbols = np.flatnonzero(table)
        table[symbols] = np.arange(1, len(symbols) + 1)
        self.edge = np.zeros((n, longest + 1), np.int32)
        codes = table[pieces.points]
        pad = np.arange(longest) >= pieces.lengths[:, None]
        known = np.flatnonzero(((codes > 0) | pad).all(axis=1))
        if not len(known) or not len(symbols):
            return
        bits = len(symbols).bit_length()
        per = 63 // bits
        parts = -(-longest // per)
        padded = np.concatenate((table[points], np.zeros(parts * per, np.uint64)))
        keys = []
        for j in range(parts):
            key = np.zeros(n, np.uint64)
            for t in range(per):
                key = (key << np.uint64(bits)) | padded[j * per + t:j * per + t + n]
            keys.append(key)
        order = _sorted_by(keys)
        ids, lengths = pieces.normal_ids[known], pieces.lengths[known]
        wide = np.zeros((len(known), parts * per), np.uint64)
        wide[:, :longest] = np.where(pad[known], 0, codes[known])
        codes = wide
        top = codes.copy()
        top[np.arange(parts * per) >= lengths[:, None]] = (1 << bits) - 1

        def packed(m: np.ndarray) -> list[np.ndarray]:
            out = []
            for j in range(parts):
                key = np.zeros(len(m), np.uint64)
                for t in range(per):
                    key = (key << np.uint64(bits)) | m[:, j * per + t]
                out.append(key)
            return out

        lo, hi = _bisect(keys, order, packed(codes), False), _bisect(keys, order, packed(top), True)
        n_edges = hi - lo
        first = np.repeat(lo - np.concatenate(([0], np.cumsum(n_edges)[:-1])), n_edges)
        position = order[first + np.arange(n_edges.sum())]
        self.edge[position, np.repeat(lengths, n_edges)] = np.repeat(ids, n_edges) + 1
