"""Byte-level BPE on whole batches, merged rank by rank in numpy.

Pre-tokens of a batch stand in one ragged array of symbols. In each round every
sequence looks up the ranks of its neighbouring pairs and merges all places of
its lowest-ranked pair, all sequences at the same time; sequences without a
known pair leave the array. What is left are the tokens.
"""

from __future__ import annotations

import json

import numpy as np
import regex

from shipyard.llm.bytetext import distinct_spans, gather

#: Fixed values of byte-level BPE: the pre-token classes and the contractions of its split pattern.
WHITE, LETTER, NUMBER, OTHER, SPECIAL = 0, 1, 2, 3, 4
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")

NO_RANK = np.int32(2**31 - 1)
UNKNOWN = 255

#: Merged pre-tokens a worker remembers; beyond that it starts afresh.
MEMO = 250_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


class ByteBpe:
    """A byte-level BPE tokenizer of a ``tokenizers`` JSON file (no prefix space,
    no normalizer), for batches of texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._check(spec)
        vocab = spec["model"]["vocab"]
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", [])}
        self.special_re = regex.compile(b"|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._fill(keys, merged)
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.memo: dict[bytes, bytes] = {}

    @staticmethod
    def _check(spec: dict) -> None:
        """Raises where the file asks for something that this class does not do."""
        model, split = spec["model"], spec.get("pre_tokenizer") or {}
        odd = {
            "model": model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")),
            "normalizer": spec.get("normalizer") is not None,
            "pre_tokenizer": split.get("type") != "ByteLevel" or bool(split.get("add_prefix_space")) or not split.get("use_regex", True),
            "added_tokens": any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip")),
        }
        found = [k for k, v in odd.items() if v]
        if found:
            raise ValueError(f"not a plain byte-level BPE tokenizer: {', '.join(found)}")

    # ------------------------------------------------------------- merge table
    def _fill(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """An open-addressed table of the pairs, at most 1/16 full."""
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 16))))
        slots = 1 << self.bits
        self.keys, self.ranks, self.merged = np.full(slots, -1, np.int64), np.full(slots, NO_RANK, np.int32), np.zeros(slots, np.int32)
        waiting, at = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[at[waiting]] < 0
            place, first = np.unique(at[waiting][free], return_index=True)
            chosen = waiting[free][first]
            self.keys[place], self.ranks[place], self.merged[place] = keys[chosen], chosen, merged[chosen]
            waiting = np.setdiff1d(waiting, chosen, assume_unique=True)
            at[waiting] = (at[waiting] + 1) & (slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_slots(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair in the merge table, of an empty slot if unknown."""
        keys = left.astype(np.int64) * self.size + right
        at = self._slot(keys)
        found = self.keys[at]
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[at[todo]]
            todo = todo[(found != keys[todo]) & (found >= 0)]
        return at

    # -------------------------------------------------------------- pre-tokens
    def _class_of(self, points: np.ndarray) -> np.ndarray:
        got = self.classes[points]
        if (got == UNKNOWN).any():
            for p in np.unique(points[got == UNKNOWN]):
                c = chr(p)
                self.classes[p] = WHITE if regex.match(r"\s", c) else LETTER if regex.match(r"\p{L}", c) else NUMBER if regex.match(r"\p{N}", c) else OTHER
            got = self.classes[points]
        return got

    def pretokens(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte starts of all pre-tokens, the id of those that are special
        strings and -1 else). Pre-tokens cover the bytes without gaps and never
        cross a document."""
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero((buf & 0xC0) != 0x80)
        n = len(at)
        points = buf[at].astype(np.int32)
        wide = np.flatnonzero(points >= 0xC0)
        if len(wide):
            lead, p = points[wide], at[wide]
            part = lambda k: (buf[np.minimum(p + k, len(buf) - 1)] & 0x3F).astype(np.int32)
            points[wide] = np.select(
                [lead < 0xE0, lead < 0xF0],
                [((lead & 0x1F) << 6) | part(1), ((lead & 0x0F) << 12) | (part(1) << 6) | part(2)],
                ((lead & 0x07) << 18) | (part(1) << 12) | (part(2) << 6) | part(3),
            )
        kind = self._class_of(points)
        begins = np.zeros(n + 1, bool)  # of a document or another stretch that is split for itself
        begins[np.searchsorted(at, offsets)] = True
        special = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.special_re:
            document = lambda x: int(np.searchsorted(offsets, x, "right"))
            hits = [m for m in self.special_re.finditer(buf.tobytes()) if document(m.start()) == document(m.end() - 1)]
            for m in hits:
                a, b = np.searchsorted(at, [m.start(), m.end()])
                kind[a:b], begins[a], begins[b] = SPECIAL, True, True
            special = np.array([m.start() for m in hits], np.int64), np.array([self.special[m.group()] for m in hits], np.int64)

        begin = np.r_[True, kind[1:] != kind[:-1]] | begins[:-1]
        # The last white-space character before other text stands alone, or joins it if it is a blank.
        white = kind == WHITE
        last = np.flatnonzero(white[:-1] & ~white[1:] & ~begins[1:-1] & (kind[1:] != SPECIAL))
        begin[last] = True
        blank = last[points[last] == 0x20]
        begin[blank + 1] = False
        # Contractions: a lone apostrophe that begins a pre-token, and the letters after it.
        quote = np.flatnonzero((points == 0x27) & begin)
        quote = quote[quote + 1 < n]
        quote = quote[(kind[quote + 1] == LETTER) & ~begins[quote + 1]]
        if len(quote):
            a = points[quote + 1]
            second = np.minimum(quote + 2, n - 1)
            b = np.where((quote + 2 < n) & ~begins[np.minimum(quote + 2, n)], points[second], 0)
            short = np.isin(a, [ord(c) for c in ONE_LETTER])
            long = np.zeros(len(quote), bool)
            for x, y in TWO_LETTERS:
                long |= (a == ord(x)) & (b == ord(y))
            for found, width in ((quote[short], 2), (quote[long], 3)):
                begin[found + 1] = False
                after = found + width
                begin[after[after < n]] = True
        starts = at[begin]
        ids = np.full(len(starts), -1, np.int64)
        if len(special[0]):
            ids[np.searchsorted(starts, special[0])] = special[1]
        return starts, ids

    # ------------------------------------------------------------------ merges
    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left of each sequence, and how many they are. All lengths are at least 1."""
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        slots = np.append(self.pair_slots(symbols[:-1], symbols[1:]), 0)
        ranks = self.ranks[slots]
        ranks[np.cumsum(lengths) - 1] = NO_RANK
        done_symbols, done_owner = [], []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(ranks, first)
            over = lowest == NO_RANK
            if over.any():
                size = np.diff(np.r_[first, len(owner)])
                over = np.repeat(over, size)
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                lowest = np.repeat(lowest, size)[~over]
                symbols, owner, slots, ranks = symbols[~over], owner[~over], slots[~over], ranks[~over]
                if not len(symbols):
                    break
            else:
                lowest = np.repeat(lowest, np.diff(np.r_[first, len(owner)]))
            where = np.flatnonzero(ranks == lowest)
            # Of overlapping places of one pair (a a a), every second one from the left.
            touching = np.r_[False, where[1:] == where[:-1] + 1]
            if touching.any():
                index = np.arange(len(where))
                where = where[(index - np.maximum.accumulate(np.where(touching, 0, index))) % 2 == 0]
            symbols[where] = self.merged[slots[where]]
            # The merged symbol takes over the end of its sequence from the one that goes.
            ending = ranks[where + 1] == NO_RANK
            ending &= np.r_[owner[1:] != owner[:-1], True][where + 1]
            stays = np.ones(len(symbols), bool)
            stays[where + 1] = False
            symbols, owner, slots, ranks = symbols[stays], owner[stays], slots[stays], ranks[stays]
            where -= np.arange(len(where))
            ranks[where[ending]] = NO_RANK
            # Only pairs with a merged symbol have a new rank.
            left = where[(where > 0)] - 1
            fresh = np.r_[where[~ending], left[owner[left] == owner[left + 1]]]
            slots[fresh] = self.pair_slots(symbols[fresh], symbols[fresh + 1])
            ranks[fresh] = self.ranks[slots[fresh]]
        if not done_owner:
            return symbols, np.zeros(0, np.int64)
        all_owner = np.concatenate(done_owner)
        order = np.argsort(all_owner, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(all_owner, minlength=len(lengths))

    # ------------------------------------------------------------------- texts
    def _merged(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of each span, and how many they are: those met before from
        the memo, the others merged together."""
        raw = buf.tobytes()
        spans = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        new = np.array([i for i, x in enumerate(spans) if x not in self.memo], np.int64)
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = np.arange(len(spans))
        if len(new):
            n = (ends - starts)[new]
            symbols, counts = self.merge(self.byte_ids[buf[gather(starts[new], n)]], n)
            packed, stop = symbols.tobytes(), (4 * np.cumsum(counts)).tolist()
            begin = 0
            for i, end in zip(new.tolist(), stop, strict=True):
                self.memo[spans[i]] = packed[begin:end]
                begin = end
        found = [self.memo[x] for x in spans]
        return np.frombuffer(b"".join(found), np.int32), np.array([len(x) >> 2 for x in found], np.int64)

    def _tokens(self, buf: np.ndarray, offsets: np.ndarray):
        starts, ids = self.pretokens(buf, offsets)
        ends = np.r_[starts[1:], len(buf)].astype(np.int64)
        first, place = distinct_spans(buf, starts, ends)
        symbols, counts = self._merged(buf, starts[first], ends[first])
        return starts, ids, place, symbols, counts

    def count(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each document of a flat text column."""
        if not len(buf):
            return np.zeros(len(offsets) - 1, np.int64)
        starts, ids, place, _, counts = self._tokens(buf, offsets)
        each = np.where(ids >= 0, 1, counts[place])
        sums = np.r_[0, np.cumsum(each)]
        return np.diff(sums[np.searchsorted(starts, offsets)])

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, offsets of the documents therein)."""
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        starts, ids, place, symbols, counts = self._tokens(buf, offsets)
        begin = np.cumsum(counts) - counts
        named = np.flatnonzero(ids >= 0)
        pool = np.r_[symbols, ids[named].astype(np.int32)]
        start, length = begin[place], counts[place]
        start[named], length[named] = len(symbols) + np.arange(len(named)), 1
        sums = np.r_[0, np.cumsum(length)]
        return pool[gather(start, length)], sums[np.searchsorted(starts, offsets)]


_loaded: dict[str, ByteBpe] = {}


def load(path: str) -> ByteBpe:
    """The tokenizer of a file, read once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]
