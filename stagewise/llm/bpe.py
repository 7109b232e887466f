"""Byte-level BPE with a tokenization automaton (operator 7).

The merge list is compiled into a deterministic automaton over tokens that
accepts exactly the correct tokenizations. It starts as one state with a loop
on every byte and takes one merge gadget after the other: the gadget of
``u v -> w`` removes the arc ``v`` from the state that ``u`` leads to (a copy
of that state if other tokens lead there too) and adds an arc ``w`` beside
each arc ``u``, leading where ``v`` led. A copied state stores only what it
lost and the gadget at which it parted from its base.

A word has one accepted path, and so has each of its prefixes. A word is
encoded left to right: a byte trie proposes the tokens that start at a place,
longest first, the transition table takes or rejects them, and a dead end goes
back one arc. Decoding emits the byte labels of the arcs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Chunks and words whose tokens a Python worker remembers (chunks: in two halves of this size, the older one goes).
CACHE = 350_000
NEVER = 1 << 60


class MergeAutomaton:
    """Tokens are numbered as in the vocabulary; state 0 is the start."""

    def __init__(self, alphabet: dict[bytes, int], merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        self.labels: dict[int, bytes] = {i: b for b, i in ids.items()}
        self.made_at = {i: -1 for i in alphabet.values()}  # gadget that made a token
        self.left: dict[int, int] = {}
        self.lost: list[dict[int, int]] = [{}]  # per state: token -> gadget that removed its arc
        self.base = [(0, 0)]  # per state: the state it was copied from, and the gadget that did it
        self.state_of = dict.fromkeys(alphabet.values(), 0)
        self._users = {0: len(self.state_of) + 1}
        for rank, (u, v) in enumerate(merges):
            self._gadget(rank, ids[u], ids[v], ids[u + v])
        self._table: list[dict[int, int]] = [{} for _ in self.lost]
        self.children: list[dict[int, int]] = [{}]  # the byte trie of all tokens
        self.token_at: list[int] = [-1]
        self._above, self._depth = [0], [0]
        self._arcs: list[tuple[tuple[int, int], ...] | None] = [()]
        self._reach = max((len(b) for b in self.labels.values()), default=0)
        for token in self.state_of:
            self._add_to_trie(token)

    def _gadget(self, rank: int, u: int, v: int, w: int) -> None:
        if w in self.made_at:
            raise ValueError(f"two merges make {self.labels[w]!r}")
        if u not in self.state_of or v not in self.state_of or not self._has_arc(self.state_of[u], v, rank):
            return  # the pair never meets: the merge never fires
        after_v = self.state_of[v]  # counted before the split: for u u -> w, w leads where the second u led
        self._users[after_v] += 1
        state = self.state_of[u]
        if self._users[state] > 1:
            self._users[state] -= 1
            self.lost.append({})
            self.base.append((state, rank))
            state = self.state_of[u] = len(self.lost) - 1
            self._users[state] = 1
        self.lost[state][v] = rank
        self.made_at[w], self.left[w] = rank, u
        self.state_of[w] = after_v

    def _has_arc(self, state: int, token: int, before: int = NEVER) -> bool:
        """Whether the state has an arc on the token, counting the gadgets before ``before``."""
        limits, t, limit = [], token, before
        while True:  # the token exists beside the arcs of its left part at the time it was made, and so on
            limits.append((t, limit))
            if t not in self.left:
                break
            limit = min(limit, self.made_at[t] + 1)
            t = self.left[t]
        until = NEVER
        while True:
            lost = self.lost[state]
            if lost:
                for t, limit in limits:
                    if lost.get(t, NEVER) < min(limit, until):
                        return False
            if not state:
                return True
            state, at = self.base[state]
            until = min(until, at)

    def step(self, state: int, token: int) -> int:
        """The transition table, filled on first use: next state, or -1."""
        row = self._table[state]
        to = row.get(token)
        if to is None:
            to = row[token] = self.state_of[token] if self._has_arc(state, token) else -1
        return to

    def _add_to_trie(self, token: int) -> None:
        node = 0
        for byte in self.labels[token]:
            to = self.children[node].get(byte)
            if to is None:
                to = self.children[node][byte] = len(self.children)
                self.children.append({})
                self.token_at.append(-1)
                self._above.append(node)
                self._depth.append(self._depth[node] + 1)
                self._arcs.append(None)
            node = to
        self.token_at[node] = token

    def _proposed(self, word: bytes, at: int) -> tuple[tuple[int, int], ...]:
        """(length, token) of the tokens whose label starts at ``at``, longest first."""
        children, node = self.children, 0
        for byte in word[at : at + self._reach]:
            to = children[node].get(byte)
            if to is None:
                break
            node = to
        arcs = self._arcs[node]
        if arcs is None:
            found, k = [], node
            while k:
                if self.token_at[k] >= 0:
                    found.append((self._depth[k], self.token_at[k]))
                k = self._above[k]
            arcs = self._arcs[node] = tuple(found)
        return arcs

    def encode(self, word: bytes) -> list[int]:
        """The tokens of one pre-split word: the accepted path, longest arcs tried first.

        A place is reached by one accepted path at most, so a place from which
        the end can't be reached is left for good and no place is visited twice.
        """
        n, at, state = len(word), 0, 0
        tokens: list[int] = []
        open_ = []
        dead: set[int] = set()
        table, arcs = self._table, iter(self._proposed(word, 0))
        while at < n:
            for length, token in arcs:
                if dead and at + length in dead:
                    continue
                to = table[state].get(token)
                if to is None:
                    to = self.step(state, token)
                if to >= 0:
                    open_.append((at, state, arcs))
                    tokens.append(token)
                    at += length
                    state = to
                    arcs = iter(self._proposed(word, at))
                    break
            else:
                dead.add(at)
                at, state, arcs = open_.pop()
                tokens.pop()
        return tokens

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.labels[i] for i in ids])


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBpe:
    """The tokenizer of a vocabulary file: specials are cut out, the rest is pre-split and run through the automaton."""

    #: The pre-split pattern, a fixed value of the vocabulary.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    #: White space of Unicode with the text up to the next: no pre-split word crosses into the following chunk.
    CHUNK = re.compile("[{0}]*[^{0}]+|[{0}]+".format(r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"))

    def __init__(self, path: str):
        import regex
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        alphabet = {b: ids[b] for b in (bytes([k]) for k in range(256))}
        self.automaton = MergeAutomaton(alphabet, [(raw(a), raw(b)) for a, b in merges], ids)
        for content, i in self.specials.items():
            self.automaton.labels[i] = content.encode()
        self._split = regex.compile(self.PATTERN).findall
        # Beyond U+024F the library's own split decides: Unicode versions differ in what a letter is.
        self._split_any = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
        self._letters = letters
        longest_first = sorted(self.specials, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.specials else None
        self._words: dict[str, list[int]] = {}
        self._chunks: dict[str, tuple[tuple[int, ...], str]] = {}
        self._older: dict[str, tuple[tuple[int, ...], str]] = {}

    def _words_of(self, chunk: str) -> list[str]:
        if max(chunk) >= "\u0250":
            raw = (bytes([self._letters[c] for c in w]) for w, _ in self._split_any(chunk))
            return [w.decode("utf-8", "surrogateescape") for w in raw]
        if chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha()):
            return [chunk]
        return self._split(chunk)

    def _encode_chunk(self, chunk: str) -> tuple[tuple[int, ...], str]:
        """A chunk that isn't in the newer half of the memory."""
        found = self._older.get(chunk)
        if found is None:
            out: list[int] = []
            for word in self._words_of(chunk):
                ids = self._words.get(word)
                if ids is None:
                    ids = self.automaton.encode(word.encode("utf-8", "surrogateescape"))
                    if len(word) < 64:
                        if len(self._words) >= CACHE:
                            self._words.clear()
                        self._words[word] = ids
                out += ids
            found = (tuple(out), ",".join(map(str, out)))
        if len(chunk) < 64:
            if len(self._chunks) >= CACHE:
                self._older, self._chunks = self._chunks, {}
            self._chunks[chunk] = found
        return found

    def encode(self, text: str) -> tuple[list[int], str]:
        """Ids, and the ids in decimal joined by commas."""
        ids: list[int] = []
        said: list[str] = []
        parts = self._special.split(text) if self._special else [text]
        for k, part in enumerate(parts):
            if k % 2:
                ids.append(self.specials[part])
                said.append(str(ids[-1]))
                continue
            for chunk in self.CHUNK.findall(part):
                found = self._chunks.get(chunk) or self._encode_chunk(chunk)
                ids += found[0]
                said.append(found[1])
        return ids, ",".join(said)

    def decode(self, ids: list[int]) -> str:
        return self.automaton.decode(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _loaded(path: str) -> ByteBpe:
    return ByteBpe(path)


def vocabulary_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoded(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``with_ids``, the ids of every whole text.

    Null and empty texts have no tokens. ``vocabulary`` is a name of a public
    file or an absolute path that every executor can open. Rows are treated
    one by one: repeated ids and rows give as many rows.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(vocabulary if "/" in vocabulary else vocabulary_path(vocabulary))
        for b in batches:
            counts, shas, backs, all_ids = [], [], [], []
            for text in b.column("text"):
                ids, said = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                shas.append(sha256(said.encode()).hexdigest())
                backs.append(sha256(bpe.decode(ids).encode()).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            cols = [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(backs, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select("doc_id", F.col("text")).mapInArrow(run, schema)


def bpe_query(docs: DataFrame) -> DataFrame:
    return encoded(docs, with_ids=False)
