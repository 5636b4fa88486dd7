"""Byte-pair encoding as a deterministic automaton over tokens, and decoding by its arc labels.

The automaton starts with one state and a loop for every byte. Merge number i, (u, v) -> w, adds a gadget: the state
that arcs u lead to gets a copy without the arc v, to which arcs u lead from then on, and wherever an arc u is, an arc w
is added that leads where v does. All arcs of a label lead to one state, so there is a state a gadget, and a token names
its target. A walk whose labels spell a word is the word's encoding, and there is exactly one, for each prefix of the
word as well: so the last token of every prefix follows from those of shorter ones by looking up arcs, from left to
right, and nothing is taken back.

Compiled, a state is a range of numbers that holds those of all its copies, and the removed arcs are a table sorted by
token and state. An arc that was removed takes along those that later merges would have built on it, so a lookup asks
for a token, its left half, and so on.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shardloom.llm.common import ship
from shardloom.llm.pretokens import END_OF_TEXT, END_OF_TEXT_ID, TextEncoder, ragged, slices

_NEVER = 1 << 30
_STEP_BITS, _ARC_BITS = 20, 20
_STEPS = 1 << _STEP_BITS
#: Words of more bytes are encoded one by one.
_SIDE_BY_SIDE = 64
_TOGETHER = 1 << 18


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def byte_of_symbol() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 characters mean themselves, and the other
    bytes, in order, the characters from U+0100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


class Automaton:
    """encode(word bytes) -> ids; decode(ids) -> bytes."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[int, int]], extra: dict[int, bytes] | None = None, memo: int = 150_000):
        size = max([*vocabulary.values(), *(extra or {})], default=0) + 1
        self.ids = vocabulary
        self.labels = [b""] * size
        for label, token in [*vocabulary.items(), *((b, a) for a, b in (extra or {}).items())]:
            self.labels[token] = label
        self.step: dict[int, int] = {}  # the labels as a trie: node and byte -> node
        self.ends = [-1]  # the token whose label ends at a node
        for label, token in vocabulary.items():
            node = 0
            for byte in label:
                key = node << 8 | byte
                following = self.step.get(key)
                if following is None:
                    following = self.step[key] = len(self.ends)
                    self.ends.append(-1)
                node = following
            self.ends[node] = token
        self._memo = memo
        self._arcs: dict[int, bool] = {}
        self._compile(merges)
        self._tables()

    def _compile(self, merges: list[tuple[int, int]]) -> None:
        """One gadget a merge, in order; then the states' ranges and the table of removed arcs."""
        size = len(self.labels)
        left, right, made = [-1] * size, [-1] * size, [_NEVER] * size
        dead = [False] * size  # no arc has this label
        target = [0] * size  # the state that the token's arcs lead to
        parents, removed, times = [-1], [-1], [-1]  # of each state: which one it is a copy of, without which arc, since when
        taken: dict[int, int] = {}  # left and right token of a merge -> time

        def has_arc(last: int, arc: int) -> bool:
            until = _NEVER
            while last >= 0:
                token, before = arc, _NEVER
                while token >= 0:
                    time = taken.get(last << 32 | token, _NEVER)
                    if time < until and time <= before and time != _NEVER:
                        return False
                    before, token = made[token], left[token]
                until, last = made[last], right[last]
            return True

        for time, (u, v) in enumerate(merges):
            w = self.ids[self.labels[u] + self.labels[v]]
            if made[w] != _NEVER:
                raise ValueError(f"merges {made[w]} and {time} make the same token")
            left[w], right[w], made[w] = u, v, time
            dead[w] = dead[u] or dead[v] or not has_arc(u, v)
            target[w] = target[v]
            if not dead[w]:
                taken[u << 32 | v] = time
                parents.append(target[u])
                removed.append(v)
                times.append(time)
                target[u] = len(parents) - 1
        # a copy comes after its original, so ranges follow from counts
        count = [1] * len(parents)
        for state in range(len(parents) - 1, 0, -1):
            count[parents[state]] += count[state]
        first, free = [0] * len(parents), [1] * len(parents)
        for state in range(1, len(parents)):
            parent = parents[state]
            first[state] = free[parent]
            free[parent] += count[state]
            free[state] = first[state] + 1
        first_of, tokens = np.array(first, np.int64), np.array(removed, np.int64)
        order = np.lexsort((first_of, tokens))[1:]  # but for the state with all arcs
        self.arc_keys = np.append(tokens[order] << 32 | first_of[order], np.iinfo(np.int64).max)
        self.arc_ends = np.append(first_of[order] + np.array(count)[order], 0)
        self.arc_times = np.append(np.array(times, np.int64)[order], 0)
        self.target = first_of[np.array(target)]
        self.left, self.made, self.dead = np.array(left, np.int64), np.array(made, np.int64), np.array(dead)

    def _has_arcs(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Do the states that these tokens lead to have these arcs? Looked up in the table of removed ones."""
        out = ~self.dead[token]
        row = np.flatnonzero(out)
        state, token = self.target[last[row]], token[row].astype(np.int64)
        before = np.full(len(row), _NEVER)
        while row.size:
            at = np.searchsorted(self.arc_keys, token << 32 | state, "right") - 1
            gone = (at >= 0) & (self.arc_keys[at] >> 32 == token) & (state < self.arc_ends[at]) & (self.arc_times[at] <= before)
            out[row[gone]] = False
            before, token = self.made[token], self.left[token]
            on = ~gone & (token >= 0)
            row, state, token, before = row[on], state[on], token[on], before[on]
        return out

    def arc(self, last: int, token: int) -> bool:
        key = last << 32 | token
        known = self._arcs.get(key)
        if known is None:
            if len(self._arcs) >= self._memo:
                self._arcs.clear()
            known = self._arcs[key] = bool(self._has_arcs(np.array([last]), np.array([token]))[0])
        return known

    def encode(self, word: bytes) -> list[int]:
        """The one walk whose labels spell the word: the last token of every prefix, from left to right, then back."""
        step, ends, arcs, arc, dead = self.step, self.ends, self._arcs.get, self.arc, self.dead
        size = len(word)
        last = [-1] * (size + 1)
        for at in range(size):
            own, node, to = last[at], 0, at
            if at and own < 0:
                raise ValueError("the vocabulary has bytes without a token")
            while to < size:
                node = step.get(node << 8 | word[to])
                if node is None:
                    break
                to += 1
                token = ends[node]
                if token >= 0 and last[to] < 0:
                    if own < 0:
                        goes = not dead[token]
                    else:
                        goes = arcs(own << 32 | token)
                        if goes is None:
                            goes = arc(own, token)
                    if goes:
                        last[to] = token
        out, at = [], size
        while at > 0:
            out.append(last[at])
            at -= len(self.labels[last[at]])
        return out[::-1]

    def _tables(self) -> None:
        """The trie's steps as an open hash table, and an empty table of arcs that have been looked up."""
        keys = np.fromiter(self.step, np.int64, len(self.step))
        nodes = np.fromiter(self.step.values(), np.int32, len(self.step))
        self.key_table, self.node_table = np.full(_STEPS, -1, np.int64), np.zeros(_STEPS, np.int32)
        at = _slot(keys, _STEP_BITS)
        left = np.arange(len(keys))
        while left.size:
            free = left[self.key_table[at[left]] < 0]
            self.key_table[at[free]] = keys[free]  # of several that want a slot, one gets it
            got = free[self.key_table[at[free]] == keys[free]]
            self.node_table[at[got]] = nodes[got]
            left = np.setdiff1d(left, got, assume_unique=True)
            at[left] = (at[left] + 1) % _STEPS
        self.end_table = np.array(self.ends, np.int32)
        self.sizes = np.array([len(x) for x in self.labels], np.int64)
        self.known = np.array([self.ends[self.step[b]] >= 0 if b in self.step else False for b in range(256)])
        self.seen_keys, self.seen_values = np.full(1 << _ARC_BITS, -1, np.int64), np.zeros(1 << _ARC_BITS, bool)

    def _labels_in(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and token of every label in the data that has arcs and stays within its word, by length, the
        longest first, and by place."""
        place = np.arange(len(data))
        node = np.zeros(len(data), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ahead = 0
        while place.size:
            keys = node << 8 | data[place + ahead]
            slot = _slot(keys, _STEP_BITS)
            there = self.key_table[slot]
            wrong = np.flatnonzero((there != keys) & (there >= 0))
            while wrong.size:
                slot[wrong] = (slot[wrong] + 1) % _STEPS
                there[wrong] = self.key_table[slot[wrong]]
                wrong = wrong[(there[wrong] != keys[wrong]) & (there[wrong] >= 0)]
            hit = there >= 0
            place, node = place[hit], self.node_table[slot[hit]].astype(np.int64)
            token = self.end_table[node]
            ahead += 1
            good = (token >= 0) & ~self.dead[token]
            found.append((place[good], place[good] + ahead, token[good]))
            on = place + ahead < ends[place]
            place, node = place[on], node[on]
        return tuple(np.concatenate(x) for x in zip(*found[::-1], strict=True)) if found else (np.zeros(0, np.int64),) * 3

    def _arcs_of(self, last: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Arcs, out of the table of those seen before where they are in it. No token (-1) leads to the first state."""
        out = ~self.dead[token]
        inner = np.flatnonzero(last >= 0)
        keys = last[inner].astype(np.int64) << 32 | token[inner]
        slot = _slot(keys, _ARC_BITS)
        out[inner] = self.seen_values[slot]
        new = np.flatnonzero(self.seen_keys[slot] != keys)
        if new.size:
            known = self._has_arcs(last[inner[new]], token[inner[new]])
            out[inner[new]] = known
            self.seen_keys[slot[new]] = keys[new]
            # of several new arcs that want a slot, one has got it, and the value must be its own
            stayed = self.seen_keys[slot[new]] == keys[new]
            self.seen_values[slot[new[stayed]]] = known[stayed]
        return out

    def encode_many(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The walks of many words side by side. data: the words' bytes, one after another; size: bytes of each word.
        All ids, and how many each word has; the same as encode(). Some _TOGETHER bytes are looked at together."""
        ends = np.cumsum(size)
        parts, at = [], 0
        while at < len(size):
            till = max(at + 1, int(np.searchsorted(ends, ends[at] - size[at] + _TOGETHER, "right")))
            parts.append(self._encoded(data[ends[at] - size[at] : ends[till - 1]], size[at:till]))
            at = till
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def _encoded(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not self.known[data].all():
            raise ValueError("the vocabulary has bytes without a token")
        start = np.cumsum(size) - size
        last = np.full(len(data) + 1, -1, np.int32)  # of every prefix of every word, at the place where it ends
        depth = np.zeros(len(size), np.int64)
        out = np.full(len(data), -1, np.int64)  # filled from each word's end
        for word in np.flatnonzero(size > _SIDE_BY_SIDE).tolist():
            ids = self.encode(data[start[word] : start[word] + size[word]].tobytes())
            depth[word] = len(ids)
            out[start[word] + size[word] - len(ids) : start[word] + size[word]] = ids
        word = np.flatnonzero((size > 0) & (size <= _SIDE_BY_SIDE))
        within = np.repeat(size <= _SIDE_BY_SIDE, size)
        ends = np.where(within, np.repeat(start + size, size), 0)
        begin_of = np.repeat(start, size)
        begins, tos, tokens = self._labels_in(data.astype(np.int64), ends)
        if not within.all():
            keep = within[begins]
            begins, tos, tokens = begins[keep], tos[keep], tokens[keep]
        # a word that is a label has one arc from the first state; the others go on prefix by prefix
        whole = (begins == begin_of[begins]) & (tos == ends[begins])
        last[tos[whole]] = tokens[whole]
        is_whole = np.zeros(len(data) + 1, bool)
        is_whole[begins[whole]] = True
        rest = word[~is_whole[start[word]]]
        left = np.flatnonzero(~is_whole[begin_of[begins]])
        left = left[np.argsort(tos[left].astype(np.int32), kind="stable")]
        begins, tos, tokens = begins[left].astype(np.int32), tos[left], tokens[left]
        first = np.concatenate([[0], np.cumsum(np.bincount(tos, minlength=len(data) + 1))])
        ahead = 1
        while rest.size:
            from_ = start[rest]
            to = from_ + ahead
            at = first[to]
            open_ = np.arange(len(rest))
            while open_.size:
                here = at[open_]
                token, begin = tokens[here], begins[here]
                goes = self._arcs_of(np.where(begin == from_[open_], -1, last[begin]), token)
                last[to[open_[goes]]] = token[goes]
                open_ = open_[~goes]
                at[open_] += 1
            ahead += 1
            rest = rest[size[rest] >= ahead]
        place = start[word] + size[word]
        while word.size:
            token = last[place]
            depth[word] += 1
            out[start[word] + size[word] - depth[word]] = token
            place = place - self.sizes[token]
            on = place > start[word]
            word, place = word[on], place[on]
        return ragged(out, start + size - depth, depth).astype("<u4"), depth

    def decode(self, ids: np.ndarray) -> bytes:
        """The labels of the arcs, one after another."""
        return b"".join(map(self.labels.__getitem__, ids.tolist()))


_loaded: dict[str, Automaton] = {}


def load(path: str) -> Automaton:
    """The automaton of a byte-level tokenizer file; once a process."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        byte = byte_of_symbol()
        as_bytes = lambda token: bytes(byte[c] for c in token)
        vocabulary = {as_bytes(t): i for t, i in model["model"]["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        merges = [(vocabulary[as_bytes(a)], vocabulary[as_bytes(b)]) for a, b in pairs]
        extra = {t["id"]: t["content"].encode() for t in model["added_tokens"]} or {END_OF_TEXT_ID: END_OF_TEXT.encode()}
        _loaded[path] = Automaton(vocabulary, merges, extra)
    return _loaded[path]


def text_encoder(path: str, special: bool = True) -> TextEncoder:
    return TextEncoder(load(path).encode_many, special)


def encode_documents(docs: DataFrame, path: str, digest: bool = False) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), decoded text; or, with digest, doc_id, n_tokens and SHA-256s of both.

    A null text counts as empty: no ids, an empty decoded text. Repeated rows give repeated rows, null ids stay null, an
    empty table gives an empty result, and other columns are not read. Long texts are encoded whole. Memory: one batch
    of texts (or its longest one), and bounded memos of words and arcs.
    """
    ship(docs.sparkSession)
    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *([("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] if digest else [("ids", pa.binary()), ("decoded", pa.string())])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, encoder = load(path), text_encoder(path)
        for whole in batches:
            for batch in slices(whole, 1):
                ids = encoder.ids(batch.column(1))
                # labels that are put together wrongly would not be UTF-8; as in lossy decoders they'd show as U+FFFD
                decoded = [automaton.decode(np.frombuffer(x, "<u4")).decode("utf-8", "replace") for x in ids]
                n = pa.array([len(x) // 4 for x in ids], pa.int64())
                if digest:
                    cells = [[hashlib.sha256(x).hexdigest() for x in ids], [hashlib.sha256(x.encode()).hexdigest() for x in decoded]]
                else:
                    cells = [ids, decoded]
                yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), n, *(pa.array(c, f.type) for c, f in zip(cells, list(out)[2:], strict=True))], schema=out)

    kinds = "ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded string"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_tokens long, {kinds}")
