"""Byte-level BPE: vocabulary, splitting and merging, shared by token counting and the codec.

Merging keeps the ranks of adjacent pairs in the leaves of a segment tree.  A leaf holds `rank * width + place`, so the
root is the leftmost pair of lowest rank; a merge changes at most three leaves and their paths.  Many short pieces
are merged at once as rows of one matrix (a tree per row); long ones use the same tree over lists.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import regex
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: the pattern that splits text before merging (published with the vocabulary); \s is spelt out as the
# Unicode property White_Space, because the regex libraries disagree on it.
_SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
LONG, CELLS, MEMO = 512, 2_000_000, 150_000
_NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """Letter that a vocabulary file writes for each byte: itself if printable Latin-1, else the next free one from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    tokens: list[bytes]  # by id
    byte_ids: np.ndarray  # id of each single byte
    pairs: np.ndarray  # sorted left * 2^20 + right
    ranks: np.ndarray  # of each pair
    merged: np.ndarray  # id by rank
    specials: dict[str, int]  # strings that stand for one token wherever they occur
    alone: frozenset[str] = frozenset()  # strings proved to be one token (see token_counts)

    @property
    def special_split(self):
        found = sorted(self.specials, key=len, reverse=True)
        return re.compile("(" + "|".join(map(re.escape, found)) + ")") if found else None


def load_vocabulary(path: str) -> Vocabulary:
    """From a tokenizers JSON file with a byte-level BPE model; read on the driver (a few MB, bounded by the vocabulary)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, model = byte_letters(), spec["model"]
    added = {x["content"]: x["id"] for x in spec["added_tokens"]}
    size = 1 + max([*model["vocab"].values(), *added.values()])
    tokens = [b""] * size
    for text, i in model["vocab"].items():
        tokens[i] = bytes(letters[c] for c in text)
    for text, i in added.items():
        tokens[i] = text.encode()
    vocab, keys, merged = model["vocab"], [], []
    for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
        keys.append((vocab[left] << 20) | vocab[right])
        merged.append(vocab[left + right])
    keys = np.array(keys, dtype=np.int64)
    order = np.argsort(keys)
    byte_ids = np.zeros(256, dtype=np.int64)
    for letter, b in letters.items():
        byte_ids[b] = vocab[letter]
    return Vocabulary(tokens, byte_ids, keys[order], order.astype(np.int64), np.array(merged, dtype=np.int64), added)


def pair_ranks(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    key = (left << 20) | right
    at = np.minimum(np.searchsorted(v.pairs, key), len(v.pairs) - 1)
    return np.where(v.pairs[at] == key, v.ranks[at], -1)


def _merge_rows(v: Vocabulary, words: list[bytes], width: int) -> list[bytes]:
    """Ids (int32, packed) of words of at most `width` bytes, width a power of two."""
    n = len(words)
    sizes = np.array([len(w) for w in words])
    flat = v.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
    symbol = np.full((n, width + 1), -1, dtype=np.int64)
    inside = np.arange(width + 1) < sizes[:, None]
    symbol[inside] = flat
    after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
    before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
    tree = np.full((n, 2 * width), _NONE, dtype=np.int64)
    paired = inside[:, 1:]
    rank = pair_ranks(v, symbol[:, :-1][paired], symbol[:, 1:][paired])
    places = np.broadcast_to(np.arange(width), (n, width))[paired]
    tree[:, width:][paired] = np.where(rank < 0, _NONE, rank * width + places)
    node = width
    while node > 1:
        node //= 2
        tree[:, node:2 * node] = np.minimum(tree[:, 2 * node:4 * node:2], tree[:, 2 * node + 1:4 * node:2])
    rows = np.flatnonzero(tree[:, 1] != _NONE)
    while rows.size:
        best = tree[rows, 1]
        place = best % width
        gone = after[rows, place]
        then = after[rows, gone]
        symbol[rows, place] = v.merged[best // width]
        symbol[rows, gone] = -1
        after[rows, place] = then
        before[rows, np.minimum(then, width)] = place
        prior = before[rows, place]
        right = np.where(then < sizes[rows], pair_ranks(v, symbol[rows, place], symbol[rows, np.minimum(then, width)]), -1)
        left = np.where(prior >= 0, pair_ranks(v, symbol[rows, np.maximum(prior, 0)], symbol[rows, place]), -1)
        for leaf, value in ((gone, np.full(rows.size, _NONE)), (place, np.where(right < 0, _NONE, right * width + place)),
                            (np.where(prior >= 0, prior, gone), np.where(left < 0, _NONE, left * width + prior))):
            at = leaf + width
            tree[rows, at] = value
            while at[0] > 1:
                at = at // 2
                tree[rows, at] = np.minimum(tree[rows, 2 * at], tree[rows, 2 * at + 1])
        rows = rows[tree[rows, 1] != _NONE]
    live = symbol >= 0
    packed, ends = symbol[live].astype("<i4").tobytes(), np.cumsum(live.sum(axis=1)) * 4
    return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _merge_long(v: Vocabulary, word: bytes) -> bytes:
    """The same tree for one long word, over plain lists."""
    n = len(word)
    width = 1 << max(1, (n - 1).bit_length())
    symbol = v.byte_ids[np.frombuffer(word, dtype=np.uint8)]
    rank = pair_ranks(v, symbol[:-1], symbol[1:])
    leaves = np.full(width, _NONE)
    leaves[:n - 1] = np.where(rank < 0, _NONE, rank * width + np.arange(n - 1))
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
    tree = [_NONE, *[x for level in reversed(levels) for x in level.tolist()]]
    symbol, after, before = symbol.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    known = dict(zip(v.pairs.tolist(), v.ranks.tolist())) if n > 1 else {}

    def put(leaf: int, value: int) -> None:
        at = leaf + width
        tree[at] = value
        while at > 1:
            at //= 2
            tree[at] = min(tree[2 * at], tree[2 * at + 1])

    def pair(i: int, j: int) -> int:
        found = known.get((symbol[i] << 20) | symbol[j])
        return _NONE if found is None else found * width + i

    while tree[1] != _NONE:
        place = tree[1] % width
        gone = after[place]
        symbol[place], symbol[gone] = int(v.merged[tree[1] // width]), -1
        put(gone, _NONE)
        after[place] = after[gone]
        if after[place] < n:
            before[after[place]] = place
        put(place, pair(place, after[place]) if after[place] < n else _NONE)
        if before[place] >= 0:
            put(before[place], pair(before[place], place))
    return np.array([s for s in symbol if s >= 0], dtype="<i4").tobytes()


def merge_many(v: Vocabulary, words: Iterable[str | bytes]) -> list[bytes]:
    """Packed ids of every pre-token, merged apart from the others."""
    raw = [w.encode() if isinstance(w, str) else w for w in words]
    out: list[bytes] = [b""] * len(raw)
    widths: dict[int, list[int]] = {}
    for i, w in enumerate(raw):
        if len(w) > LONG:
            out[i] = _merge_long(v, w)
        elif w:
            widths.setdefault(1 << max(1, (len(w) - 1).bit_length()), []).append(i)
    for width, members in widths.items():
        step = max(1, CELLS // (4 * width))
        for a in range(0, len(members), step):
            part = members[a:a + step]
            for i, ids in zip(part, _merge_rows(v, [raw[i] for i in part], width)):
                out[i] = ids
    return out


class Splitter:
    """Cuts texts into pieces that never share a pre-token: at single spaces between visible characters.

    A piece stands with the space before it unless it begins a segment; the special strings are segments of their own.
    """

    def __init__(self, v: Vocabulary):
        self.special, self.pre = v.special_split, regex.compile(PATTERN).findall
        self.odd, self.cut = re.compile(r" \s|\s ").search, re.compile(r"(?<=\S) (?=\S)").split
        self.specials = v.specials

    def segments(self, text: str) -> list[str]:
        if self.special is None or not any(s in text for s in self.specials):
            return [text] if text else []
        return [s for s in self.special.split(text) if s]

    def pieces(self, segment: str) -> list[str]:
        return self.cut(segment) if self.odd(segment) else segment.split(" ")


class Memo:
    """What pieces become, remembered up to a number of pieces: `value(pre-tokens) -> object` fills it."""

    def __init__(self, splitter: Splitter, values):
        self.splitter, self.values, self.by_piece = splitter, values, {}

    def learn(self, pieces: set[str]) -> None:
        """Makes sure that all pieces (each with its leading space) are known."""
        if len(self.by_piece) > MEMO:
            self.by_piece.clear()
        new = [p for p in pieces if p not in self.by_piece]
        if new:
            self.by_piece.update(zip(new, self.values([self.splitter.pre(" " + p) for p in new])))


def coded(v: Vocabulary, splitter: Splitter, memo: Memo, texts: list[str], special_value) -> list[list]:
    """Per text the values of its pieces in order."""
    cut, wanted = [], set()
    for text in texts:
        parts = []
        for segment in splitter.segments(text):
            if segment in v.specials:
                parts.append((segment, None))
            else:
                pieces = splitter.pieces(segment)
                parts.append((pieces[0], pieces[1:]))
                wanted.update(pieces[1:])
        cut.append(parts)
    memo.learn(wanted)
    first = [p for parts in cut for p, rest in parts if rest is not None]
    heads = iter(memo.values([splitter.pre(p) for p in first]))
    get, out = memo.by_piece.__getitem__, []
    for parts in cut:
        values = []
        for p, rest in parts:
            if rest is None:
                values.append(special_value(v.specials[p]))
            else:
                values.append(next(heads))
                values.extend(map(get, rest))
        out.append(values)
    return out
