"""Token ids of a word-level byte BPE (lower case, white space dropped, word ends
marked), batch by batch in numpy, equal to the ``tokenizers`` library.

White space never joins what stands on its two sides, so a text is the sequence of
its stretches between ASCII white space. Stretches of plain ASCII and Latin-1
letters are split into words here and merged by ranks; any other stretch (other
scripts, combining marks, control characters, special strings) goes to the library.
Words met before come from a memo.
"""

from __future__ import annotations

import json

import numpy as np
from tokenizers import Tokenizer

from shipyard.llm.bpe import MEMO, ONE_LETTER, TWO_LETTERS, ByteBpe, byte_alphabet
from shipyard.llm.bytetext import SPACE, distinct_spans, gather

# The settings of the tokenizer file that this module implements.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

WHITE, LETTER, DIGIT, OTHER, HARD = range(5)


def _classes() -> np.ndarray:
    """The class of every byte of plain text; lead bytes of Latin-1 letters and
    continuation bytes count as letters."""
    kind = np.full(256, HARD, np.uint8)
    kind[0x21:0x7F] = OTHER
    for c in range(0x21, 0x7F):
        if chr(c).isalpha():
            kind[c] = LETTER
        elif chr(c).isdigit():
            kind[c] = DIGIT
    kind[SPACE] = WHITE
    kind[0x80:0xC0] = LETTER
    kind[0xC3] = LETTER
    return kind


CLASSES = _classes()


class WordBpe(ByteBpe):
    """A BPE with word ends of a ``tokenizers`` JSON file. Raises for a file whose
    normalizer, splitting or word ends are not those implemented here."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, normalizer = spec["model"], spec["normalizer"] or {}
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if (
            model.get("end_of_word_suffix") != WORD_END
            or [n["type"] for n in normalizer.get("normalizers", [])] != NORMALIZERS
            or splits[0].get("pattern") != {"Regex": PATTERN}
            or any(p["type"] == "ByteLevel" and (p["add_prefix_space"] or p["use_regex"]) for p in splits)
        ):
            raise ValueError(f"{path} is not a word BPE of the kind that is implemented here")
        vocab = model["vocab"]
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], np.int32)
        self.end_ids = np.array([vocab[c + WORD_END] for c in byte_alphabet()], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        self._fill(np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64), np.array([vocab[a + b] for a, b in pairs], np.int32))
        self.memo: dict[bytes, bytes] = {}
        self.library = Tokenizer.from_file(path)
        self.marks = sorted({t["content"][:2].encode() for t in spec.get("added_tokens", [])})

    def words(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(lower-cased bytes, starts and ends of all words, which of them are
        stretches for the library; those keep their bytes)."""
        low = buf.copy()
        low[(buf >= 0x41) & (buf <= 0x5A)] += 0x20
        kind = CLASSES[buf]
        lead = np.flatnonzero(buf == 0xC3)
        after = buf[np.minimum(lead + 1, len(buf) - 1)]
        capital = (after >= 0x80) & (after <= 0x9E) & (after != 0x97)
        low[lead[capital] + 1] += 0x20
        sign = lead[(after == 0x97) | (after == 0xB7)]
        kind[sign] = kind[sign + 1] = OTHER

        edge = np.zeros(len(buf) + 1, bool)
        edge[offsets] = True
        solid = kind != WHITE
        stretch = np.flatnonzero(solid & (~np.r_[False, solid[:-1]] | edge[:-1]))
        stretch_end = np.flatnonzero(solid & (~np.r_[solid[1:], False] | edge[1:])) + 1
        hard = kind == HARD
        for mark in self.marks:
            first, second = mark[0], mark[1]
            hard[:-1] |= (buf[:-1] == first) & (buf[1:] == second)
        touched = np.unique(np.searchsorted(stretch, np.flatnonzero(hard), "right") - 1)
        inside = gather(stretch[touched], (stretch_end - stretch)[touched])
        kind[inside] = HARD
        low[inside] = buf[inside]

        begin = np.r_[True, kind[1:] != kind[:-1]] | edge[:-1] | (kind == DIGIT)
        begin[stretch] = True
        # Contractions: an apostrophe that begins a word, and the letters after it.
        padded = np.r_[low, np.zeros(3, np.uint8)]
        quote = np.flatnonzero((low == 0x27) & begin & (kind == OTHER))
        if len(quote):
            same = np.r_[~edge[1:], np.zeros(3, bool)]  # the next byte belongs to the same document
            a, b = padded[quote + 1], np.where(same[quote + 1], padded[quote + 2], 0)
            a = np.where(same[quote], a, 0)
            short = np.isin(a, [ord(c) for c in ONE_LETTER])
            long = np.zeros(len(quote), bool)
            for x, y in TWO_LETTERS:
                long |= (a == ord(x)) & (b == ord(y))
            for found, width in ((quote[short], 2), (quote[long], 3)):
                begin[found + 1] = False
                rest = found + width
                begin[rest[rest < len(buf)]] = True
        begin &= solid
        starts = np.flatnonzero(begin)
        # A word ends where the next one begins, or at the end of its stretch.
        limit = stretch_end[np.searchsorted(stretch, starts, "right") - 1]
        ends = np.minimum(np.r_[starts[1:], len(buf)], limit)
        return low, starts, ends, kind[starts] == HARD

    def _of(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each different word, and how many they are."""
        raw = buf.tobytes()
        # A stretch for the library is told apart from an equal word by a byte that no text holds.
        spans = [raw[a:b] + b"\xff" if h else raw[a:b] for a, b, h in zip(starts.tolist(), ends.tolist(), hard.tolist(), strict=True)]
        new = np.array([i for i, x in enumerate(spans) if x not in self.memo], np.int64)
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = np.arange(len(spans))
        plain = new[~hard[new]]
        if len(plain):
            n = (ends - starts)[plain]
            symbols = self.byte_ids[buf[gather(starts[plain], n)]]
            last = np.cumsum(n) - 1
            symbols[last] = self.end_ids[buf[ends[plain] - 1]]
            symbols, counts = self.merge(symbols, n)
            packed, begin = symbols.tobytes(), 0
            for i, end in zip(plain.tolist(), (4 * np.cumsum(counts)).tolist(), strict=True):
                self.memo[spans[i]] = packed[begin:end]
                begin = end
        odd = new[hard[new]].tolist()
        if odd:
            texts = [spans[i][:-1].decode() for i in odd]
            for i, found in zip(odd, self.library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                self.memo[spans[i]] = np.array(found.ids, np.int32).tobytes()
        found = [self.memo[x] for x in spans]
        return np.frombuffer(b"".join(found), np.int32), np.array([len(x) >> 2 for x in found], np.int64)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, offsets of the documents therein)."""
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        low, starts, ends, hard = self.words(buf, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        symbols, length, place = [], [], np.zeros(len(starts), np.int64)
        for flag in (False, True):  # different words of either sort
            of = np.flatnonzero(hard == flag)
            if len(of):
                first, where = distinct_spans(low, starts[of], ends[of])
                place[of] = where + sum(map(len, length))
                got, counts = self._of(low, starts[of][first], ends[of][first], hard[of][first])
                symbols.append(got)
                length.append(counts)
        symbols, length = np.concatenate(symbols), np.concatenate(length)
        begin = np.cumsum(length) - length
        sums = np.r_[0, np.cumsum(length[place])]
        return symbols[gather(begin[place], length[place])], sums[np.searchsorted(starts, offsets)]

    def count(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each document of a flat text column."""
        return np.diff(self.encode(buf, offsets)[1])


_loaded: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The tokenizer of a file, read once in each Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBpe(path)
    return _loaded[path]
