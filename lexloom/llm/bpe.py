"""Byte-level BPE: encoding and decoding with rank tables.

A pre-token that is itself in the table is one token. Any other is merged from its bytes: the
pair whose joined bytes have the lowest rank goes first, the leftmost of equal ones before the
others. The pre-tokens of a batch are merged together in one linked list of parts, whose links
end at the borders of a pre-token. Pending pairs wait in buckets, one per rank, that hold
their positions in the list; a bitmap of three levels tells the lowest rank that has any. All
pairs of the chosen rank are merged at once, unless that could make a pair of a still lower
rank: then only the leftmost of each pre-token is. An entry whose pair has changed meanwhile
is stale and is skipped when its bucket comes up. A pre-token of millions of bytes therefore
takes no more time per byte than a short one.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from lexloom.llm.batches import Chunks, blank_chunks, chunk_text, held, map_columns

WORD_BITS = 6  # of a rank, for each level of the bitmap
WORD_MASK = (1 << WORD_BITS) - 1
# Texts whose new pre-tokens are merged together: the more, the fewer rounds per pre-token.
ROWS_AT_ONCE = 4096
# Bytes merged together, in whole pre-tokens: bounds a worker's memory to about 100 MB.
BYTES_AT_ONCE = 2_000_000


class RankBitmap:
    """The set of ranks whose bucket has entries."""

    def __init__(self, ranks: int):
        words = (ranks >> WORD_BITS) + 1
        self._low = [0] * words
        self._mid = [0] * ((words >> WORD_BITS) + 1)
        self._top = 0

    def add(self, rank: int) -> None:
        word = rank >> WORD_BITS
        group = word >> WORD_BITS
        self._low[word] |= 1 << (rank & WORD_MASK)
        self._mid[group] |= 1 << (word & WORD_MASK)
        self._top |= 1 << group

    def pop_first(self) -> int:
        """Take the lowest rank out, found by the first set bit of each level; -1 if none."""
        top = self._top
        if not top:
            return -1
        group = (top & -top).bit_length() - 1
        bits = self._mid[group]
        word = (group << WORD_BITS) + (bits & -bits).bit_length() - 1
        bits = self._low[word]
        rank = (word << WORD_BITS) + (bits & -bits).bit_length() - 1
        self._low[word] = bits & (bits - 1)
        if not self._low[word]:
            self._mid[group] &= self._mid[group] - 1
            if not self._mid[group]:
                self._top &= top - 1
        return rank


class Merger:
    """Merges the bytes of pre-tokens by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values(), default=0) + 1
        self._none = size  # stands for "no part": a pair with it has no rank
        self._stride = size + 1
        self._byte_ids = np.array([ranks.get(bytes([b]), size) for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self._stride + right] = rank
        self._keys = np.array(sorted(pairs), np.int64)
        self._pair_ranks = np.array([pairs[k] for k in self._keys.tolist()], np.int32)
        # One entry more, so that a search beyond the last key finds something unequal.
        self._keys = np.append(self._keys, np.int64(-1))
        self._pair_ranks = np.append(self._pair_ranks, np.int32(-1))
        # Ranks whose token is part of a pair of a lower rank; none in most vocabularies.
        self._undercut = np.zeros(size + 1, bool)
        for part in divmod(self._keys[:-1], self._stride):
            self._undercut[part[part > self._pair_ranks[:-1]]] = True
        self._bitmap = RankBitmap(size)
        self._buckets: list[list[np.ndarray]] = [[] for _ in range(size)]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self._stride + right
        at = np.searchsorted(self._keys[:-1], keys)
        return np.where(self._keys[at] == keys, self._pair_ranks[at], -1)

    def _push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        real = ranks >= 0
        positions, ranks = positions[real], ranks[real]
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *edges.tolist()] if len(ranks) else []
        for start, stop, rank in zip(
            starts, [*starts[1:], len(ranks)], ranks[starts].tolist() if starts else []
        ):
            self._buckets[rank].append(positions[start:stop])
            self._bitmap.add(rank)

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (32-bit unsigned little-endian)."""
        done = [self.ranks.get(piece) for piece in pieces]
        out = [b"" if i is None else array("I", (i,)).tobytes() for i in done]
        todo = [i for i, (known, piece) in enumerate(zip(done, pieces)) if known is None and piece]
        while todo:
            room, taken = BYTES_AT_ONCE, 0
            while taken < len(todo) and (not taken or len(pieces[todo[taken]]) <= room):
                room -= len(pieces[todo[taken]])
                taken += 1
            now, todo = todo[:taken], todo[taken:]
            for i, ids in zip(now, self._merge([pieces[i] for i in now])):
                out[i] = ids
        return out

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stops = np.cumsum(lengths)
        starts, end = stops - lengths, int(stops[-1])
        ids = np.append(self._byte_ids[np.frombuffer(b"".join(pieces), np.uint8)], self._none)
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        # The position `end` stands for "nothing" on either side.
        after = np.arange(1, end + 2, dtype=np.int32)
        before = np.arange(-1, end, dtype=np.int32)
        after[stops - 1], before[starts] = end, end
        alive = np.ones(end, bool)
        waiting = np.full(end + 1, -1, np.int32)  # rank of the pair that starts here
        waiting[:end] = self._rank(ids[:end], ids[after[:end]])
        self._push(np.arange(end, dtype=np.int32), waiting[:end])
        buckets, bitmap = self._buckets, self._bitmap
        while (rank := bitmap.pop_first()) >= 0:
            entries, buckets[rank] = buckets[rank], []
            at = entries[0] if len(entries) == 1 else np.concatenate(entries)
            at = at[waiting[at] == rank]  # the others are stale
            if not at.size:
                continue
            if at.size > 1:
                at = found = np.unique(at)
                touching = after[at[:-1]] == at[1:]
                if touching.any():  # of pairs that share parts every other one is merged
                    index = np.arange(at.size)
                    first = np.append(True, ~touching)
                    run = np.maximum.accumulate(np.where(first, index, 0))
                    at = at[(index - run) % 2 == 0]
            own = np.full(at.size, rank, np.int64)
            right = after[at]
            stop = after[right]
            if at.size > 1 and self._undercut[rank]:
                near = np.concatenate((own, ids[before[at]], own[:1]))
                far = np.concatenate((ids[stop], own, own[:1]))
                made = self._rank(near, far)
                if ((made >= 0) & (made < rank)).any():
                    leftmost = np.append(True, piece[found[1:]] != piece[found[:-1]])
                    at = found[leftmost]
                    self._push(rest := found[~leftmost], np.full(rest.size, rank, np.int32))
                    own, right = own[:1].repeat(at.size), after[at]
                    stop = after[right]
            ids[at], after[at], before[stop] = rank, stop, at
            alive[right], waiting[right] = False, -1
            left = before[at]
            new = self._rank(np.concatenate((own, ids[left])), np.concatenate((ids[stop], own)))
            changed = np.concatenate((at, left))
            waiting[changed] = new
            self._push(changed, new)
        kept = np.flatnonzero(alive)
        packed = ids[kept].astype("<u4").tobytes()
        edges = [0, *(np.searchsorted(kept, stops) * 4).tolist()]
        return [packed[a:b] for a, b in zip(edges, edges[1:])]


def read_ranks(path: str) -> bytes:
    """The content of a rank file (a line per token: its bytes in base64, its rank)."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    rows = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in rows}


def _encoder(content: bytes, pattern: str) -> tuple[Chunks, dict[int, bytes]]:
    """What encodes texts, and the token of each rank."""
    ranks = parse_ranks(content)
    merge = Merger(ranks)
    findall = regex.compile(pattern).findall

    def solve(names: list[str]) -> list[bytes]:
        cut = [findall(chunk_text(name)) for name in names]
        tokens = list({token for chunk in cut for token in chunk})
        ids = dict(zip(tokens, merge([token.encode() for token in tokens])))
        return [b"".join([ids[token] for token in chunk]) for chunk in cut]

    return Chunks(blank_chunks(findall), solve), _token_table(ranks)


def _token_table(ranks: dict[bytes, int]) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks.items()}


def _shared_ranks(spark: SparkSession, path: str):
    # A vocabulary file is of a fixed size, whatever the corpus.
    return spark.sparkContext.broadcast(read_ranks(path))


def _joined(tokens: dict[int, bytes], ids: bytes | None) -> bytes:
    return b"".join(map(tokens.__getitem__, array("I", ids or b"")))


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    keep: tuple = ("doc_id",),
    decoded: bool = False,
) -> DataFrame:
    """`keep`, ids (binary: 32-bit unsigned little-endian), n_tokens (long) per row.

    Each match of `pattern` in the whole text is encoded by itself; special tokens are
    ordinary text. The pattern must be one whose matches hold a blank at most in front, or
    are white space. A null text counts as empty: no ids. Repeated rows are each encoded,
    very long texts as a whole; an empty table gives no rows. Other columns are not read. With `decoded`, the ids are decoded again in the same worker,
    as `decode` does.
    """
    content = _shared_ranks(docs.sparkSession, ranks_path)

    def make():
        name = ("bpe", ranks_path, pattern)
        chunks, tokens = held(name, lambda: _encoder(content.value, pattern))

        def work(texts):
            ids = chunks(texts, b"".join)
            counts = [len(x) // 4 for x in ids]
            return (ids, counts, [_joined(tokens, x) for x in ids]) if decoded else (ids, counts)

        return work

    outputs = "ids binary, n_tokens bigint" + ", decoded binary" * decoded
    return map_columns(docs, make, [text], keep, outputs, ROWS_AT_ONCE)


def decode(
    encoded: DataFrame, ranks_path: str, ids: str = "ids", keep: tuple = ("doc_id",)
) -> DataFrame:
    """`keep` and decoded (binary): the bytes of the tokens one after another.

    Null ids give no bytes; an id outside the vocabulary is an error.
    """
    content = _shared_ranks(encoded.sparkSession, ranks_path)

    def make():
        name = ("ranks", ranks_path)
        tokens = held(name, lambda: _token_table(parse_ranks(content.value)))
        return lambda packed: ([_joined(tokens, x) for x in packed],)

    return map_columns(encoded, make, [ids], keep, "decoded binary")
