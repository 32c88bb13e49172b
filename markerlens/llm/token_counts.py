"""Token counts by a compiled finite-state transducer.

A byte-level BPE tokenizer is compiled into a deterministic transducer over bytes whose transitions
carry the tokens they add. A state is what the rest of a word can still depend on: the longest suffix
that begins a longer token, and for each place in it where one can begin the last token of the split
up to there and the count relative to now. A split is the tokenizer's own exactly when each neighbouring pair of tokens is, so one candidate
survives each byte. States are made when first met, kept by the worker, and dropped when too many.
Word starts (the tokenizer's split pattern, a rule on a few neighbouring character classes) reset the
state.

A text is cut into chunks. A chunk's map from the state before it to (state after it, tokens) is constant
behind its first word start; only its head depends on the state before. The maps compose by a
scan: all chunks run side by side from their first word start, then the heads whose state
before is known run side by side, until none is left.

Defined cases: null and empty texts have 0 tokens; texts of any length are counted whole; repeated rows are
counted each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markerlens.llm.text_arrays import row_slices, segment_sums, utf8

LIMIT = 1024
CHUNK = 256
#: Cells of the transition table (states times different bytes met) at which a worker starts anew.
MOST_CELLS = 1 << 25
LETTER, NUMBER, SPACE, OTHER = range(4)
#: Endings that the split pattern keeps with their apostrophe (fixed by the pattern).
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


_CLASSES: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """Class of each code point, asked from the library's own split: a character goes on with a letter,
    a number or a mark before it, or else is white space."""
    if not _CLASSES:
        from tokenizers.pre_tokenizers import ByteLevel

        split = ByteLevel(add_prefix_space=False, use_regex=True)
        out = np.full(0x110000, OTHER, np.uint8)  # Unicode has no letters, numbers or spaces beyond plane 3
        points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x34000)])
        out[points] = SPACE
        for lo in range(0, len(points), 512):  # short probes: the library's offsets cost more in long ones
            some = points[lo: lo + 512]
            for name, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
                probe = "".join(f" {before}{chr(c)}" for c in some)
                begins = np.zeros(3 * len(some) + 1, bool)
                begins[[at for _, (at, _) in split.pre_tokenize_str(probe)]] = True
                out[some[~begins[2:-1:3]]] = name
        _CLASSES.append(out)
    return _CLASSES[0]


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary: printable ones for themselves, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Transitions and their emitted counts, extended while texts run."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, of = spec["model"], byte_letters()
        spell = lambda t: bytes(of[c] for c in t)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(spell(a), spell(b)): i for i, (a, b) in enumerate(pairs)}
        tokens = {spell(t) for t in model["vocab"]}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.prefixes = {t[:i] for t in tokens for i in range(1, len(t))}
        self.tokens, self.fixed, self.pairs = tokens, {}, {}
        self.clear()

    def clear(self):
        self.states = [(b"", ((None, 0),))]
        self.index = {self.states[0]: 0}
        self.column, self.bytes = np.full(256, -1, np.int64), []
        self.next = np.full((1 << 12, 64), -1, np.int32)
        self.emit = np.zeros((1 << 12, 64), np.int8)

    def widen(self, data: np.ndarray) -> None:
        """Give each byte of the texts a column of the table."""
        for b in np.flatnonzero(np.bincount(data, minlength=256)).tolist():
            if self.column[b] < 0:
                self.column[b] = len(self.bytes)
                self.bytes.append(b)
        while len(self.bytes) > self.next.shape[1]:
            self.next = np.concatenate([self.next, np.full_like(self.next, -1)], axis=1)
            self.emit = np.concatenate([self.emit, np.zeros_like(self.emit)], axis=1)

    def merge(self, word: bytes) -> list[bytes]:
        """The tokenizer's merges on one word."""
        parts = [bytes([b]) for b in word]
        while len(parts) > 1:
            ranks = [self.rank.get(p, 1 << 30) for p in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 30:
                break
            at = ranks.index(best)
            parts[at: at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stands(self, before: bytes | None, token: bytes) -> bool:
        """Whether the tokenizer leaves ``token`` as it is, behind ``before``."""
        if token not in self.fixed:
            self.fixed[token] = len(self.merge(token)) == 1
        if before is None or not self.fixed[token]:
            return self.fixed[token]
        key = (before, token)
        if key not in self.pairs:
            self.pairs[key] = self.merge(before + token) == [before, token]
        return self.pairs[key]

    def add(self, state: int, column: int) -> None:
        suffix, places = self.states[state]
        word = suffix + bytes([self.bytes[column]])
        for k, place in enumerate(places):
            token = word[k:]
            if place and token in self.tokens and self.stands(place[0], token):
                gain = place[1] + 1
                break
        keep = next((k for k in range(len(word)) if word[k:] in self.prefixes), len(word))
        left = tuple(p and word[k:] in self.prefixes and (p[0], p[1] - gain) for k, p in enumerate(places[keep:], keep))
        key = (word[keep:], (*left, (token, 0)))
        if key not in self.index:
            self.index[key] = len(self.states)
            self.states.append(key)
            if len(self.states) > len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
                self.emit = np.concatenate([self.emit, np.zeros_like(self.emit)])
        self.next[state, column], self.emit[state, column] = self.index[key], gain

    def run(self, buf, resets, starts, lengths, states) -> tuple[np.ndarray, np.ndarray]:
        """Run spans side by side from their states: states after them and tokens added."""
        order = np.argsort(-lengths, kind="stable")
        at, length, state = starts[order], lengths[order], states[order].astype(np.int64)
        total = np.zeros(len(order), np.int64)
        active = len(order) - np.searchsorted(length[::-1], np.arange(int(length[0]) if len(length) else 0), "right")
        for t, n in enumerate(active.tolist()):
            place = at[:n] + t
            s = np.where(resets[place], 0, state[:n])
            flat = s * self.next.shape[1] + self.column[buf[place]]
            to = self.next.reshape(-1)[flat]
            if (to < 0).any():
                for k in np.unique(flat[to < 0]).tolist():
                    self.add(*divmod(k, self.next.shape[1]))
                to = self.next.reshape(-1)[flat]
            total[:n] += self.emit.reshape(-1)[flat]
            state[:n] = to
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def counts(self, buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        if self.next.size >= MOST_CELLS and len(self.states) > 0.9 * len(self.next):
            self.clear()
        self.widen(buf)
        resets = word_starts(buf, offsets, classes)
        n = -(-np.diff(offsets) // CHUNK)
        cut = np.concatenate([[0], np.cumsum(n)])
        start = np.repeat(offsets[:-1], n) + (np.arange(cut[-1]) - np.repeat(cut[:-1], n)) * CHUNK
        stop = np.minimum(start + CHUNK, np.repeat(offsets[1:], n))
        where = np.append(np.flatnonzero(resets), len(buf))
        body = np.minimum(where[np.searchsorted(where, start)], stop)
        after, total = self.run(buf, resets, body, stop - body, np.zeros(len(start), np.int64))
        known = body < stop
        waiting = np.flatnonzero(body > start)  # never the first chunk of a text, which starts a word
        while len(waiting):
            ready = known[waiting - 1]
            now = waiting[ready]
            end, more = self.run(buf, resets, start[now], body[now] - start[now], after[now - 1])
            total[now] += more
            through = body[now] == stop[now]
            after[now[through]] = end[through]
            known[now] = True
            waiting = waiting[~ready]
        return segment_sums(total, cut)


def code_points(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and value of each character."""
    first = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[first].astype(np.int32)
    size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    value = np.where(size == 1, lead, lead & (0xFF >> (size + 1)))
    for k in range(1, 4):
        more = size > k
        value[more] = value[more] << 6 | (buf[first[more] + k] & 0x3F)
    return first, value


def word_starts(buf: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Mask of the bytes at which the split pattern starts a word; every text starts one."""
    resets = np.zeros(len(buf), bool)
    if not len(buf):
        return resets
    first, value = code_points(buf)
    kind = classes[value]
    n = len(first)
    opens = np.zeros(n + 1, bool)  # first character of a text (and behind the last)
    opens[np.searchsorted(first, offsets)] = True
    space = kind == SPACE
    before = np.concatenate([[OTHER], kind[:-1]])
    blank = np.concatenate([[False], value[:-1] == 32])
    last_space = space & ~np.append(space[1:], True) & ~opens[1:]
    start = np.where(space, (before != SPACE) | last_space, (kind != before) & ~blank)
    start |= opens[:-1]
    quote = np.flatnonzero((value == 39) & start)
    for ending in ENDINGS:
        k = len(ending)
        q = quote[quote + k < n]
        fits = np.ones(len(q), bool)
        for i, c in enumerate(ending, 1):
            fits &= (value[q + i] == ord(c)) & ~opens[q + i]
        q = q[fits]
        start[q + 1] = False
        q = q[q + k + 1 < n]
        start[q + k + 1] = True
    resets[first[start]] = True
    return resets


_COMPILED: dict[str, Transducer] = {}


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row of ``docs`` (doc_id, text)."""
    table = docs.sparkSession.sparkContext.broadcast(class_table())

    def count(batches):
        if tokenizer not in _COMPILED:
            _COMPILED[tokenizer] = Transducer(tokenizer)
        machine = _COMPILED[tokenizer]
        for batch in batches:
            for part in row_slices(batch, "text", 2 << 20):
                column, extra = part.column("text"), np.zeros(part.num_rows, np.int64)
                buf, offsets = utf8(column)
                owner = np.arange(part.num_rows)
                data = buf.tobytes()
                if any(s.encode() in data for s in machine.special):  # special strings are a token each and part the text
                    pieces, owner = split_special(column.to_pylist(), machine.special)
                    extra = np.bincount(owner, minlength=part.num_rows) - 1
                    sizes = np.diff(offsets)
                    buf, offsets = utf8(pa.array(pieces, pa.large_string()))
                    tokens = machine.counts(buf, offsets, table.value)
                else:
                    sizes = np.diff(offsets)
                    tokens = machine.counts(buf, offsets, table.value)
                total = np.bincount(owner, tokens, part.num_rows).astype(np.int64) + extra
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes), pa.array(total), pa.array(total > limit)],
                                                 names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def split_special(texts: list[str], special: list[str]) -> tuple[list[str], np.ndarray]:
    """Texts without their special strings, cut there, and the number of the text of each part."""
    import re

    pattern = re.compile("|".join(map(re.escape, special)))
    parts = [pattern.split(t) for t in texts]
    return [p for ps in parts for p in ps], np.repeat(np.arange(len(texts)), [len(p) for p in parts])
