"""Packing by minimum bin slack (operator 10).

Texts become token ids; a long document fills whole windows and leaves one
remainder. Remainders are dealt into groups of bounded size. In a group the
largest remaining length opens a window and a bitset subset-sum over the
multiset of the other lengths finds the fill closest to the capacity; the
counts of each length are backtracked from the bitsets, and the same fill is
repeated while the counts last.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import vocabulary_path
from .common import released, ship, stored

WINDOW = 4096
END_ID = 2
#: Remainders of a group: one group leaves one or a few windows with slack.
GROUP = 20_000
#: With more strings than this a Python worker remembers those of its last batch only; fewer need less memory and more time.
REMEMBERED = 1_000_000
#: A character that is one id of its own between blanks; strings that hold it are encoded alone.
MARK = "\x01"
#: Strings that one text for the library holds, and strings of one call.
JOINED, AT_ONCE = 256, 256 * 64
#: Texts whose strings are looked up together.
TEXTS = 10_000


class WordIds:
    """Ids of texts as little-endian 32-bit numbers, by the tokenizers library.

    Neither the normalizer nor the pre-split of this vocabulary joins text
    across a blank or line feed, so the strings between them are encoded apart
    from their texts: once for each batch, and not at all while they are
    remembered. Many go to the library in one call, with MARK between blanks
    as a string of its own whose id shows where each one ends. Strings and
    their ids stay in Arrow arrays.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self._remembered = remembered
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        mark, marked = self._encoded([MARK, f"a {MARK} b {MARK}"])
        self._mark = mark[0]
        if len(mark) != 1 or (marked == mark[0]).tolist() != [False, True, False, True]:
            raise ValueError(f"{path} doesn't encode blank-separated strings one by one")
        self.forget()

    def forget(self) -> None:
        self._strings, self._ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _apart(self, strings: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of the strings, none of which holds MARK, and how many each one has."""
        between = pa.scalar(f" {MARK} ", pa.large_string())
        ids, sizes = [], []
        for k in range(0, len(strings), AT_ONCE):
            some = strings.slice(k, AT_ONCE)
            starts = pa.array([*range(0, len(some), JOINED), len(some)], pa.int64())
            joined = pc.binary_join(pa.LargeListArray.from_arrays(starts, some), between)
            flat = np.concatenate(self._encoded([f"{x} {MARK}" for x in joined.to_pylist()]))
            ends = flat == self._mark
            ids.append(flat[~ends])
            sizes.append(np.diff(np.flatnonzero(ends), prepend=-1) - 1)
        return ids, sizes

    def _ids_of(self, strings: pa.Array) -> pa.Array:
        """The ids (binary) of each of these distinct strings."""
        new = strings.filter(pc.is_null(pc.index_in(strings, value_set=self._strings)))
        if len(new):
            marked = pc.match_substring(new, MARK)
            plain, rest = new.filter(pc.invert(marked)), new.filter(marked)
            ids, sizes = self._apart(plain)
            alone = self._encoded(rest.to_pylist())
            flat = np.concatenate([*ids, *alone])
            size = np.concatenate([*sizes, [len(x) for x in alone]]).astype(np.int64)
            ends = pa.py_buffer(4 * np.concatenate([[0], np.cumsum(size)]))
            found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(new), [None, ends, pa.py_buffer(flat)])
            self._strings = pa.concat_arrays([self._strings, plain, rest])
            self._ids = pa.concat_arrays([self._ids, found])
        out = self._ids.take(pc.index_in(strings, value_set=self._strings))
        if len(self._strings) > self._remembered:  # those of this batch stay
            short = pc.less(pc.binary_length(strings), 64)
            self._strings, self._ids = strings.filter(short), out.filter(short)
        return out

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of every text; null: none."""
        texts = pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), "\n", " ")
        lists = pc.split_pattern(texts, " ")
        strings = lists.flatten().dictionary_encode()
        ids = self._ids_of(strings.dictionary).take(strings.indices)
        starts = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
        raw = memoryview(ids.buffers()[2] or b"")
        at = starts[0]
        for end in starts[np.cumsum(pc.list_value_length(lists).to_numpy())]:
            yield raw[at:end].tobytes()
            at = end


@lru_cache(maxsize=2)
def _loaded(path: str, remembered: int) -> WordIds:
    return WordIds(path, remembered)


def pieces(
    docs: DataFrame, vocabulary: str = "word_bpe_49k.json", window: int = WINDOW, end_id: int = END_ID,
    with_ids: bool = False, remembered: int = REMEMBERED, texts_at_once: int = TEXTS,
    forget: bool = False,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids) of each piece: whole windows, then the remainder.

    Every document ends with ``end_id``, so a null or empty text is one piece of length 1.
    ``forget``: a worker remembers strings within one task only and then gives the memory back.
    """
    ship(docs.sparkSession)
    tail = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _loaded(vocabulary if "/" in vocabulary else vocabulary_path(vocabulary), remembered)
        for b in batches:
            at, start, length, crc, total, ids = [], [], [], [], [], []
            texts = b.column("text")
            slices = (texts.slice(k, texts_at_once) for k in range(0, len(texts), texts_at_once))
            for k, raw in enumerate(x for some in slices for x in words.encode_all(some)):
                raw += tail
                n = len(raw) // 4
                for s in range(0, n, window):
                    piece = raw[4 * s : 4 * (s + window)]
                    at.append(k)
                    start.append(s)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if with_ids:
                        ids.append(piece)
            cols = [b.column("doc_id").take(pa.array(at, pa.int64()))]
            cols += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
        if forget:
            words.forget()
        pa.default_memory_pool().release_unused()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(released(run) if forget else run, schema)


def best_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, within their counts, whose sum is the largest up to ``capacity``.

    Lengths are taken from the largest down, a count c as lumps of 1, 2, 4 ..
    copies; the bitset before each lump shows later whether the lump is needed.
    """
    reach, full, seen = 1, 1 << capacity, []
    within = (full << 1) - 1
    for size in sorted((s for s in counts if s <= capacity), reverse=True):
        left, lump = min(counts[size], capacity // size), 1
        while left > 0 and not reach & full:
            lump = min(lump, left)
            seen.append((size, lump, reach))
            reach |= (reach << (size * lump)) & within
            left -= lump
            lump *= 2
        if reach & full:
            break
    total, used = reach.bit_length() - 1, {}
    for size, lump, before in reversed(seen):
        if not before >> total & 1:
            total -= size * lump
            used[size] = used.get(size, 0) + lump
    return used


def fills(lengths: list[int], window: int = WINDOW) -> Iterator[tuple[dict[int, int], int]]:
    """(lengths of a window with their counts, number of such windows) until all lengths are placed."""
    counts: dict[int, int] = defaultdict(int)
    for x in lengths:
        counts[x] += 1
    while counts:
        top = max(counts)
        counts[top] -= 1
        if not counts[top]:
            del counts[top]
        fill = best_fill(counts, window - top)
        counts[top] = counts.get(top, 0) + 1
        fill[top] = fill.get(top, 0) + 1
        times = min(counts[s] // c for s, c in fill.items())
        for s, c in fill.items():
            counts[s] -= c * times
            if not counts[s]:
                del counts[s]
        yield fill, times


def _pack_group(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    rows = pa.Table.from_batches(got).sort_by([("length", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
    rows = rows.combine_chunks()
    lengths = rows.column("length").to_numpy()
    first = dict(zip(*[x.tolist() for x in np.unique(lengths, return_index=True)], strict=True))
    part = TaskContext.get().partitionId() << 33
    order = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    at = 0
    for fill, times in fills(lengths.tolist(), window):
        for _ in range(times):
            used = 0
            for size, count in sorted(fill.items(), reverse=True):
                k = first[size]
                order[k : k + count] = at
                offset[k : k + count] = used + size * np.arange(count)
                used += size * count
                first[size] = k + count
            at += 1
    rows = rows.append_column("sequence_id", pa.array(2 * (part + order)))
    rows = rows.append_column("offset", pa.array(offset))
    yield from rows.to_batches(10_000)


def packed_pieces(cut: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``cut`` (see pieces) with sequence_id and offset.

    Whole windows are sequences of their own; remainders share sequences with
    others of their group. Groups are dealt out evenly, whatever the keys, and
    hold some ``group`` small rows each. An empty table gives an empty result.
    """
    cut = stored(cut, "pieces")
    whole = (
        cut.where(F.col("length") == window)
        .withColumn("sequence_id", 2 * F.monotonically_increasing_id() + 1)
        .withColumn("offset", F.lit(0).cast("long"))
    )
    rest = cut.where(F.col("length") < window)
    n = max(1, -(-rest.count() // group))
    schema = whole.schema
    return whole.unionByName(rest.repartition(n).mapInArrow(lambda b: _pack_group(b, window), schema))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids (little-endian 32-bit) of each sequence, from packed pieces that carry ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.unhex(F.array_join(parts["ids"], "")).alias("ids"))


def packing_query(docs: DataFrame) -> DataFrame:
    return packed_pieces(pieces(docs))
