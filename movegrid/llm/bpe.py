"""Byte-level byte-pair encoding by ranks: merges, pair compatibility, and the tree join.

Two monoids are used.

*Tokens of one pre-token.*  A token sequence is the encoding of its bytes exactly if every
neighbouring pair of tokens is itself the encoding of its own bytes: as long as no merge
crosses a boundary, the two tokens beside it develop as they do alone, so the first merge to
cross would also cross in the pair alone.  Two encoded halves are therefore joined by
re-encoding a window of tokens around the seam and growing it until the pairs at both window
edges are compatible; all tokens outside stand.

*Pre-tokens of one text.*  The splitting pattern scans left to right and looks at most at the
next character (three for a contraction), so every pre-token that ends before the end of a
half and starts three or more characters before it is the same whatever follows.  The seam is
split again from the first pre-token that may change, on a growing window, until a boundary
coincides with one of the right half; from there on the right half's pre-tokens stand.
"""
from __future__ import annotations

import base64
import heapq
import re

import regex

#: The pattern that splits text before the merges (fixed value of the vocabulary's format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOOKAHEAD = 3        # characters the longest contraction looks at
#: The same pattern for text below U+0100, with its letters, numbers and white space spelt out.
LATIN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[{0}]+| ?[{1}]+| ?[^{0}{1}{2}]+|[{2}]+(?![^{2}])|[{2}]+""".format(
    "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0")
TEXT_LEAF = 1 << 14  # texts up to this many characters are split in one go
TOKEN_LEAF = 8       # byte strings up to this long are merged in one go
SHORT = 64           # byte strings up to this long are merged without a heap
CACHE = 250_000      # entries kept in each of a worker's caches
CACHE_BYTES = 64     # longest pre-token that is kept
NONE = 1 << 62       # rank of two parts that no merge joins


_split_any = regex.compile(PATTERN).findall
_split_latin = re.compile(LATIN).findall
_beyond_latin = re.compile("[^\x00-\xff]").search


def split_leaf(text: str) -> list[str]:
    return _split_any(text) if _beyond_latin(text) else _split_latin(text)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank from the lines of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}


def unstable(parts: list[str]) -> int:
    """How many trailing pre-tokens may change when text is appended."""
    n = size = 0
    for p in reversed(parts):
        if n and size + len(p) >= LOOKAHEAD:
            break
        size += len(p)
        n += 1
    return n


def join_parts(left: list[str], right: list[str]) -> list[str]:
    """Pre-tokens of the concatenation of two texts, given the pre-tokens of each."""
    if not left or not right:
        return left or right
    cut = len(left) - unstable(left)
    tail = "".join(left[cut:])
    width = 2
    while True:
        width = min(width, len(right))
        whole = width == len(right)
        window = split_leaf(tail + "".join(right[:width]))
        if whole and width <= 2:
            return left[:cut] + window
        stable = len(window) if whole else len(window) - unstable(window)
        starts, at = {}, len(tail)
        for j in range(width):
            starts[at] = j
            at += len(right[j])
        at = 0
        for k in range(stable + 1):
            if at in starts:
                return left[:cut] + window[:k] + right[starts[at]:]
            if k < stable:
                at += len(window[k])
        if whole:
            return left[:cut] + window
        width *= 2


def split_text(text: str) -> list[str]:
    """Pre-tokens of a text, by halves above the leaf size."""
    if len(text) <= TEXT_LEAF:
        return split_leaf(text)
    half = len(text) // 2
    return join_parts(split_text(text[:half]), split_text(text[half:]))


class Cache(dict):
    """Pre-token to ``make(pre-token)``, long keys are not kept.  When it is full, its entries become the older half, of which
    those asked for again return; the rest goes when it fills up next."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, part):
        value = self.older.get(part)
        if value is None:
            value = self.make(part)
        if len(part) <= CACHE_BYTES:
            if len(self) >= CACHE // 2:
                self.older = dict(self)
                self.clear()
            self[part] = value
        return value


class Encoder:
    """Encodes pre-tokens by ranks, with a bounded cache; one lives in each Python worker."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.get = ranks, ranks.get
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.tokens[r] = t
        self.pairs: dict[tuple[int, int], list[int]] = {}
        self.leaves = Cache(self.merge)

    def merge(self, data: bytes) -> list[int]:
        """Merges of lowest rank first, leftmost among equals, on all of ``data``."""
        return self.merge_short(data) if len(data) <= SHORT else self.merge_long(data)

    def merge_short(self, data: bytes) -> list[int]:
        """By a list of the ranks of neighbouring parts, scanned for the least."""
        get, n = self.get, len(data)
        at = list(range(n + 1))
        rank = [get(data[i:i + 2], NONE) for i in range(n - 1)]
        while rank and (least := min(rank)) != NONE:
            i = rank.index(least)
            del at[i + 1], rank[i]
            if i < len(rank):
                rank[i] = get(data[at[i]:at[i + 2]], NONE)
            if i:
                rank[i - 1] = get(data[at[i - 1]:at[i + 1]], NONE)
        ranks = self.ranks
        return [ranks[data[a:b]] for a, b in zip(at, at[1:])]

    def merge_long(self, data: bytes) -> list[int]:
        """By linked parts and a heap of the neighbours that can merge."""
        n, ranks = len(data), self.ranks
        end = list(range(1, n + 1))          # end[i]: where the part starting at i ends
        prev = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j < 0 or j >= n or end[j] != stop:
                continue                      # one of the two parts has changed since
            end[i], end[j] = stop, -1
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(data[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def seam(self, a: int, b: int) -> list[int]:
        """Encoding of two tokens' bytes; they are compatible if it is the two themselves."""
        if (known := self.pairs.get((a, b))) is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.tokens[a] + self.tokens[b])
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of two neighbouring encoded byte strings of one pre-token."""
        if not left or not right:
            return left or right
        a, b = left[-1], right[0]
        window = self.seam(a, b)
        if window == [a, b]:
            return left + right
        i = j = 1
        while True:
            left_ok = i == len(left) or self.seam(left[-i - 1], window[0]) == [left[-i - 1], window[0]]
            right_ok = j == len(right) or self.seam(window[-1], right[j]) == [window[-1], right[j]]
            if left_ok and right_ok:
                return left[:len(left) - i] + window + right[j:]
            i, j = min(len(left), i * (1 if left_ok else 2)), min(len(right), j * (1 if right_ok else 2))
            window = self.merge(b"".join([self.tokens[t] for t in left[len(left) - i:] + right[:j]]))

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= TOKEN_LEAF:
            return self.leaves[data]
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def encode_part(self, part: str) -> list[int]:
        """Ids of one pre-token: itself if it is a token, else by the tree."""
        data = part.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        return [rank] if rank is not None else self.tree(data)
