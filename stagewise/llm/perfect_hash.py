"""Minimal perfect hashes of bounded sets of byte strings, with the keys stored for verification."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Seed of the words' hashes, which is that of Spark's xxhash64() too; a set's own seed is mixed into them.
HASH_SEED = 42
#: Keys that share a displacement, on average.
BUCKET = 4


@dataclass(frozen=True)
class PerfectHash:
    """``seed`` mixed into the hashes, ``shifts``: a displacement for each bucket, ``keys`` in the order of their slots."""

    seed: int
    shifts: np.ndarray
    keys: pa.Array


def key_hashes(words: Sequence[bytes]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.array([h(w, HASH_SEED) for w in words], np.uint64)


def _parts(h: np.ndarray, seed: np.ndarray | int, n: np.ndarray | int, buckets: np.ndarray | int) -> tuple[np.ndarray, ...]:
    """Bucket, first place and step of each hash, from bits that overlap little."""
    h = h + np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h = h ^ (h >> np.uint64(31))
    n, buckets = np.asarray(n, np.uint64), np.asarray(buckets, np.uint64)
    parts = (h >> np.uint64(40)) % buckets, (h & np.uint64(0xFFFFFFFF)) % n, (h >> np.uint64(20)) % n
    return tuple(p.astype(np.int64) for p in parts)


def build(words: Sequence[bytes], attempts: int = 64) -> PerfectHash:
    """A minimal perfect hash of distinct words by hashing and displacing.

    Buckets, the largest first, take the first displacement at which all their
    words fall on free slots; one-word buckets take the slots that are left.
    Words with equal 64-bit hashes can't be told apart (for sets of some
    thousand words, 1 in 10**12 sets has such) and raise an error.
    """
    n = len(words)
    if not n:
        return PerfectHash(0, np.zeros(1, np.int64), pa.array([], pa.large_binary()))
    hashes = key_hashes(words)
    for seed in range(attempts):
        made = _placed(hashes, seed, n)
        if made is not None:
            shifts, at = made
            keys = np.empty(n, object)
            keys[at] = list(words)
            return PerfectHash(seed, shifts, pa.array(keys.tolist(), pa.large_binary()))
    raise ValueError("no perfect hash: the words, or their hashes, are not distinct")


def _placed(h: np.ndarray, seed: int, n: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Displacements and slots, or None if two words can't be told apart under this seed."""
    buckets = -(-n // BUCKET)
    bucket, first, second = _parts(h, seed, n, buckets)
    order = np.argsort(bucket, kind="stable")
    starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    size = np.diff(starts)
    taken, shifts, at = np.zeros(n, bool), np.zeros(buckets, np.int64), np.zeros(n, np.int64)
    for b in np.argsort(-size, kind="stable"):
        own = order[starts[b] : starts[b + 1]]
        if len(own) <= 1:
            break
        for turn in range(n):
            base = (first[own] + turn * second[own]) % n
            if len(np.unique(base)) < len(own):
                continue
            clash = np.zeros(n, bool)
            for p in base:  # taken, seen from every displacement
                clash |= np.roll(taken, -p)
            free = int(np.argmin(clash))
            if not clash[free]:
                shifts[b] = turn * n + free
                at[own] = (base + free) % n
                taken[at[own]] = True
                break
        else:
            return None
    single = np.flatnonzero(size == 1)
    own = order[starts[single]]
    at[own] = np.flatnonzero(~taken)
    shifts[single] = (at[own] - first[own]) % n
    return shifts, at


@dataclass(frozen=True)
class ShardedHash:
    """Some of the ``shards`` perfect hashes of a set whose words are dealt to shards by hash.

    By shard: ``size`` (0: not here), ``seed``, ``buckets``, and where its slots
    (``first``) and displacements (``shift_at``) begin in ``keys`` and ``shifts``.
    """

    size: np.ndarray
    seed: np.ndarray
    buckets: np.ndarray
    first: np.ndarray
    shift_at: np.ndarray
    shifts: np.ndarray
    keys: pa.Array

    @staticmethod
    def of(shards: int, made: dict[int, PerfectHash]) -> ShardedHash:
        empty = PerfectHash(0, np.zeros(0, np.int64), pa.array([], pa.large_binary()))
        all_ = [made.get(k, empty) for k in range(shards)]
        size, buckets = (np.array([len(x) for x in part], np.int64) for part in ([m.keys for m in all_], [m.shifts for m in all_]))
        return ShardedHash(
            size, np.array([m.seed for m in all_], np.int64), buckets, np.cumsum(size) - size, np.cumsum(buckets) - buckets,
            np.concatenate([m.shifts for m in all_]), pa.concat_arrays([m.keys for m in all_]),
        )

    def places(self, words: Sequence[bytes]) -> np.ndarray:
        """``first`` of its shard + slot of each word; -1 for one that is no key here: the key stored there is compared."""
        h = key_hashes(words)
        shard = np.mod(h.view(np.int64), len(self.size))
        out = np.full(len(h), -1)
        here = np.flatnonzero(self.size[shard] > 0)
        if len(here):
            shard = shard[here]
            n = self.size[shard]
            bucket, first, second = _parts(h[here], self.seed[shard], n, self.buckets[shard])
            shift = self.shifts[self.shift_at[shard] + bucket]
            at = self.first[shard] + (first + shift // n * second + shift % n) % n
            given = pa.array(words, pa.large_binary())
            same = pc.equal(self.keys.take(pa.array(at)), given if len(here) == len(h) else given.take(pa.array(here)))
            same = same.to_numpy(zero_copy_only=False)
            out[here[same]] = at[same]
        return out
