"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token starts as a linked list of its bytes. Every neighbouring pair that the ranks know waits in the bucket of
its rank. Which buckets hold something is kept in a hierarchy of two bitmaps: words of as many bits as the root of the
number of ranks, and one word that says which of them aren't zero. A find-first-set on each level finds the next rank.
A bucket hands out its leftmost position first; an entry whose pair has changed since it was queued is stale and skipped. A pre-token of n bytes takes O(n) queue operations, whatever its length.

Pre-tokens repeat, so the ids of short ones are kept in a cache of bounded size. Long ones never enter it.

Cases: a null or empty text has no ids and decodes to no bytes. Any text encodes, since every byte is a token. Lone
surrogates can't occur in Spark strings. Decoding refuses ids that the ranks don't have.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable
from itertools import chain

import regex

#: Pre-tokens of more bytes are encoded anew each time; the cache is emptied when it holds this many.
CACHED_BYTES, CACHED_ENTRIES = 64, 400_000


class _Cache(dict):
    """Ids by pre-token; a missing one is encoded."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, token: str) -> tuple[int, ...]:
        data = token.encode()
        ids = tuple(self.codec.encode_piece(data))
        if len(data) <= CACHED_BYTES:
            if len(self) >= CACHED_ENTRIES:
                self.clear()
            self[token] = ids
        return ids


class Codec:
    """Encoder and decoder for one set of ranks (bytes to rank) and one pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        #: Bits of a rank that choose the bit within a word; those above choose the word.
        self.low = -(-max(ranks.values(), default=1).bit_length() // 2)
        self.words = [0] * ((max(ranks.values(), default=0) >> self.low) + 1)
        self.bit = [1 << i for i in range(max(1 << self.low, len(self.words)))]
        self.cache = _Cache(self)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Codec:
        """Ranks from lines of base64 token and rank."""
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.cache.__getitem__, self.split(text))))

    def encode_piece(self, data: bytes) -> list[int]:
        """The ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n, known, low, bit, words = len(data), ranks.get, self.low, self.bit, self.words
        mask, summary = (1 << low) - 1, 0  # summary: the words that aren't zero
        buckets: dict[int, list[int]] = {}
        unsorted = set()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [-1] * n  # rank of the pair that starts here; -1 for none, and for nodes that are gone
        for i in range(n - 1):
            rank = known(data[i : i + 2])
            if rank is not None:
                waiting[i] = rank
                if rank in buckets:
                    buckets[rank].append(i)
                    unsorted.add(rank)
                else:
                    buckets[rank] = [i]
                    word = rank >> low
                    words[word] |= bit[rank & mask]
                    summary |= bit[word]
        while summary:
            word = (summary & -summary).bit_length() - 1
            held = words[word]
            rank = word << low | (held & -held).bit_length() - 1
            bucket = buckets[rank]
            if rank in unsorted:
                bucket.sort(reverse=True)
                unsorted.discard(rank)
            left = bucket.pop()
            if not bucket:
                del buckets[rank]
                held &= held - 1
                words[word] = held
                if not held:
                    summary &= summary - 1
            if waiting[left] != rank:
                continue  # stale
            right = after[left]
            end = after[right]
            after[left] = end
            waiting[right] = waiting[left] = -1
            changed = (left,)
            if end < n:
                before[end] = left
            prior = before[left]
            if prior >= 0:
                changed = (prior, left)
            for start in changed:
                then = after[start]
                if then == n:
                    continue
                rank = known(data[start : after[then]])
                if rank is None:
                    waiting[start] = -1
                    continue
                waiting[start] = rank
                if rank in buckets:
                    buckets[rank].append(start)
                    unsorted.add(rank)
                else:
                    buckets[rank] = [start]
                    word = rank >> low
                    words[word] |= bit[rank & mask]
                    summary |= bit[word]
        out, at = [], 0
        while at < n:
            out.append(ranks[data[at : after[at]]])
            at = after[at]
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a vocabulary file, read once in each Python worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec.from_file(path, pattern)
    return _CODECS[path, pattern]
