"""Byte-level BPE encoding and decoding by merge replay.

The distinct pieces of a block of documents are one corpus. An inverted index from mergeable pair, named by the rank of what
it makes, to the positions where the pair stands is built once; then every merge is applied to the whole corpus at once, in
rank order, and only the neighbours of the positions it touched get new entries. A task remembers what it has replayed, up
to a bound, so a piece that recurs in its blocks is replayed once.

A replay of the distinct pieces of the whole table, by buckets, gave the same ids but not within the limits; see the README.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain, islice

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import read_table, tidy, with_ids

#: The rank file that the registered query encodes with.
RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of text of a block, about; a longer text is a block of its own.
BLOCK_CHARS = 2_000_000
#: Pieces that a task remembers, about; beyond that it forgets all of them and starts anew.
REMEMBERED = 200_000
#: Bytes of pieces that are replayed at a time.
REPLAY_BYTES = 2_000_000
NONE = np.int64(-1)


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines with a base64 token and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class MergeReplay:
    """Encodes pieces and decodes ids by the given ranks; the ids are those of one-at-a-time merging."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.byte_id = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if (self.byte_id < 0).any():
            raise ValueError("the ranks lack single bytes")
        self.base = max(ranks.values()) + 1
        keys, to = [], []
        for t, r in ranks.items():
            for cut in range(1, len(t)):
                a, b = ranks.get(t[:cut]), ranks.get(t[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    to.append(r)
        order = np.argsort(np.array(keys, dtype=np.int64)) if keys else np.array([], dtype=np.int64)
        self.pair_keys, self.pair_ranks = np.array(keys, dtype=np.int64)[order], np.array(to, dtype=np.int64)[order]

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, -1 where they do not merge."""
        if not len(self.pair_keys):
            return np.full(len(a), NONE)
        want = a * self.base + b
        at = np.minimum(np.searchsorted(self.pair_keys, want), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == want, self.pair_ranks[at], NONE)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece; an empty piece has none."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = len(raw)
        if n == 0:
            return [[] for _ in pieces]
        sym = self.byte_id[raw]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        first = np.zeros(n, dtype=bool)
        first[(ends - lengths)[lengths > 0]] = True
        nxt = np.arange(1, n + 1, dtype=np.int64)
        nxt[ends[lengths > 0] - 1] = n  # n: nothing follows
        prv = np.arange(-1, n - 1, dtype=np.int64)
        prv[first] = -1
        sym = np.append(sym, -1)
        odd: set[int] = set()  # pieces in which a merge made a pair of a lower rank

        index: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def add(ranks: np.ndarray, at: np.ndarray) -> None:
            found = ranks >= 0
            ranks, at = ranks[found], at[found]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, at = ranks[order], at[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, part in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts), strict=True):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(queue, r)

        starts = np.flatnonzero(nxt < n)
        add(self._rank_of(sym[starts], sym[nxt[starts]]), starts)
        while queue:
            r = heapq.heappop(queue)
            parts = index.pop(r)
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            at = at[(sym[at] >= 0) & (nxt[at] < n)]
            at = at[self._rank_of(sym[at], sym[nxt[at]]) == r]  # some have merged otherwise since
            if not len(at):
                continue
            at = np.unique(at)
            if len(at) > 1:  # of overlapping pairs the leftmost goes first
                joined = np.concatenate(([False], nxt[at[:-1]] == at[1:]))
                if joined.any():
                    place = np.arange(len(at))
                    run = np.maximum.accumulate(np.where(joined, 0, place))
                    at = at[(place - run) % 2 == 0]
            right = nxt[at]
            after = nxt[right]
            sym[at] = r
            sym[right] = -1
            nxt[at] = after
            inner = after < n
            prv[after[inner]] = at[inner]
            rank_right = np.full(len(at), NONE)
            rank_right[inner] = self._rank_of(sym[at[inner]], sym[after[inner]])
            before = prv[at]
            has = before >= 0
            rank_left = self._rank_of(sym[before[has]], sym[at[has]])
            for ranks, owners in ((rank_right, owner[at]), (rank_left, owner[at[has]])):
                early = (ranks >= 0) & (ranks <= r)
                if early.any():
                    odd.update(owners[early].tolist())
            add(np.concatenate((rank_right, rank_left)), np.concatenate((at, before[has])))
        live = np.flatnonzero(sym[:n] >= 0)
        ids, owners = sym[live].tolist(), owner[live]
        cuts = np.searchsorted(owners, np.arange(len(pieces) + 1)).tolist()
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for k in odd:
            out[k] = self.encode_one(pieces[k])
        return out

    def encode_one(self, piece: bytes) -> list[int]:
        """One piece by itself: always the lowest rank, and of equal ranks the leftmost."""
        n = len(piece)
        sym = [int(self.byte_id[b]) for b in piece]
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        parts = [piece[i : i + 1] for i in range(n)]
        heap: list[tuple[int, int, int, int]] = []

        def push(i: int) -> None:
            j = nxt[i]
            if j < n and (r := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, sym[i], sym[j]))

        for i in range(n):
            push(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            parts[i] += parts[j]
            sym[i], sym[j] = r, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            push(i)
            if prv[i] >= 0:
                push(prv[i])
        return [s for s in sym if s >= 0]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@cache
def replay_of(path: str) -> MergeReplay:
    """The tables of a rank file, once for each process; their size is that of the vocabulary."""
    return MergeReplay(load_ranks(path))


def replay_all(replay: MergeReplay, pieces: Iterable[str]) -> list[list[int]]:
    """The ids of each piece, REPLAY_BYTES bytes of pieces or one piece at a time; lone surrogates count as "?"."""
    coded, held, size = [], [], 0
    for p in pieces:
        held.append(p.encode("utf-8", "replace"))
        size += len(held[-1])
        if size >= REPLAY_BYTES:
            coded += replay.encode_pieces(held)
            held, size = [], 0
    return coded + replay.encode_pieces(held)


class _Places(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        found = self[key] = len(self)
        return found


class Encoder:
    """Texts to ids, with a bounded memory of pieces: their ids, these in decimal, and the bytes that they stand for."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.replay = replay_of(path)
        self.find = regex.compile(pattern).findall
        self.forget()

    def forget(self) -> None:
        self.places, self.ids, self.decimal, self.decoded = _Places(), [], [], []

    def sequences(self, texts: Iterable[str]) -> list[list[int]]:
        """Each text as places of its pieces in ids, decimal and decoded. The new pieces of all texts are replayed together."""
        if len(self.places) > REMEMBERED:
            self.forget()
        place = self.places.__getitem__
        found = [list(map(place, self.find(t))) for t in texts]
        new = replay_all(self.replay, islice(self.places, len(self.ids), None))
        self.ids += new
        self.decimal += [",".join(map(str, own)) for own in new]
        self.decoded += [self.replay.decode(own) for own in new]
        return found

    def encode_block(self, texts: Iterable[str]) -> list[list[int]]:
        """The ids of each text."""
        found = self.sequences(texts)
        return [list(chain.from_iterable(map(self.ids.__getitem__, own))) for own in found]


def text_blocks(frames: Iterator[pd.DataFrame], column: str = "text") -> Iterator[pd.DataFrame]:
    """The rows anew, BLOCK_CHARS characters or a little more at a time."""
    held: list[pd.DataFrame] = []
    chars = 0
    for frame in frames:
        frame[column] = frame[column].where(frame[column].notna(), "")
        sizes = frame[column].str.len().to_numpy()
        start = 0
        for stop in range(1, len(frame) + 1):
            chars += int(sizes[stop - 1])
            if chars >= BLOCK_CHARS:
                yield pd.concat([*held, frame.iloc[start:stop]], ignore_index=True)
                held, chars, start = [], 0, stop
        if start < len(frame):
            held.append(frame.iloc[start:])
    if held:
        yield pd.concat(held, ignore_index=True)


def _by_block(docs: DataFrame, path: str, make: Callable[[Encoder, list[str]], dict[str, list]], schema: str) -> DataFrame:
    """doc_id and the columns that make gives for the texts of a block."""

    @tidy
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path)
        for block in text_blocks(frames):
            yield pd.DataFrame({"doc_id": block["doc_id"], **make(encoder, block["text"].tolist())})

    return with_ids(docs, "text", run, schema)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids, the array of token ids of the whole text.

    Null and empty texts have no tokens; lone surrogates count as "?"; an empty table gives no rows. Repeated rows are
    encoded each. Very long texts are blocks of their own. Other columns of docs, whatever their names, are not read.
    """
    return _by_block(docs, path, lambda encoder, texts: {"ids": encoder.encode_block(texts)}, "ids array<int>")


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded, the bytes that the ids stand for."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        replay = replay_of(path)
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "decoded": [replay.decode(ids) for ids in frame["ids"]]})

    return with_ids(rows, "ids", run, "decoded binary")


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """For each row as encode_texts has it: doc_id, n_tokens, ids_sha256 and decoded_sha256, without passing the ids on."""

    def make(encoder: Encoder, texts: list[str]) -> dict[str, list]:
        rows = []
        for own in encoder.sequences(texts):
            ids = ",".join(map(encoder.decimal.__getitem__, own)).encode()
            decoded = b"".join(map(encoder.decoded.__getitem__, own))
            rows.append((sum(map(len, map(encoder.ids.__getitem__, own))), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return dict(zip(("n_tokens", "ids_sha256", "decoded_sha256"), map(list, zip(*rows, strict=True)), strict=True)) if rows else {}

    return _by_block(docs, path, make, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
ORACLES: dict[str, str] = {}
