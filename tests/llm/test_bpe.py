import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shipyard.llm import bpe
from shipyard.llm.bytetext import distinct_spans, flat
from shipyard.llm.packing import SumOfSquares, pack, sequences, token_pieces
from shipyard.llm.token_counts import token_counts
from tests.llm.cases import TEXTS, documents, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")


LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture
def library():
    return LIBRARY


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ODD = st.sampled_from(["'s", "'re", "'", " ", "  ", "\n", " ", "\x1c", "\x85", "é", "漢字", "😀", "don't", "12", "²", "<|endoftext|>", "<|endo", "aaaa", "...", " '", "'ve ", "́", "ſ", "\x00"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.lists(ODD, max_size=12).map("".join), st.text(max_size=30), st.none()), max_size=8))
def test_ids_equal_the_library(texts):
    ids, at = bpe.load(PATH).encode(*flat(pa.array(texts, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [ids_of(LIBRARY, t) for t in texts]


def test_long_single_word(library):
    text = "".join(chr(97 + (i * i) % 26) for i in range(20_000))
    assert bpe.load(PATH).count(*flat(pa.array([text])))[0] == len(ids_of(library, text))


def test_memo_restarts(library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    model = bpe.ByteBpe(PATH)
    for text in ("one two three four five", "six seven eight", "one two three"):
        assert model.encode(*flat(pa.array([text])))[0].tolist() == ids_of(library, text)


def test_distinct_spans_by_bytes():
    buf = np.frombuffer(b"abc" * 9 + b"xyzabcabcabcabcabcabc", np.uint8)
    starts, ends = np.array([0, 3, 0, 6, 30, 27]), np.array([3, 6, 18, 24, 48, 30])
    first, place = distinct_spans(buf, starts, ends)
    texts = [buf[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert [texts[first[p]] for p in place] == texts and len(first) == len(set(texts))


def test_token_counts(spark, library):
    got = {(r["doc_id"], r["n_bytes"]): r for r in token_counts(documents(spark), PATH, limit=512).collect()}
    for doc_id, text, *_ in TEXTS:
        n, r = len(ids_of(library, text)), got[doc_id, len((text or "").encode())]
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 512)
    assert token_counts(documents(spark), PATH).count() == len(TEXTS)
    assert token_counts(empty(spark), PATH).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts(empty(spark), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=40))
def test_sum_of_squares_by_brute_force(items):
    packer, opened = SumOfSquares(12), {}

    def squares(gaps):
        values = [g for g in gaps.values() if g]
        return sum(values.count(g) ** 2 for g in set(values))

    for n in items:
        sequence, offset = packer.place(n)
        fits = {s: g for s, g in opened.items() if g >= n}
        if fits:
            best = min(((squares({**opened, s: g - n}), g) for s, g in fits.items()))
            assert (squares({**opened, sequence: opened[sequence] - n}), opened[sequence]) == best
        else:
            assert sequence not in opened
            opened[sequence] = 12
        assert offset == 12 - opened[sequence]
        opened[sequence] -= n


def test_packing_round_trip(spark, library):
    capacity = 64
    pieces = token_pieces(documents(spark), PATH, capacity)
    packed = pack(pieces, expected_rows=14, capacity=capacity, group_rows=5).cache()
    rows = packed.collect()
    whole = {r["sequence_id"]: r for r in sequences(packed).collect()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert whole[r["sequence_id"]]["ids"][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        ends = [a + n for a, n in sorted(parts)]
        assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    for doc_id, text, *_ in TEXTS:
        ids = [*ids_of(library, text), 2]
        copies = sum(x[:2] == (doc_id, text) for x in TEXTS)
        for k, start in enumerate([0, *range((len(ids) - 1) % capacity + 1, len(ids), capacity)]):
            length = (len(ids) - 1) % capacity + 1 if k == 0 else capacity
            want = np.array(ids[start : start + length], "<u4").tobytes()
            same = [r for r in by_doc[doc_id] if (r["piece"], r["start"], r["length"], bytes(r["ids"])) == (k, start, length, want)]
            assert len(same) == copies
    assert pack(token_pieces(empty(spark), PATH), 0).count() == 0


def test_few_sequences_are_used(spark):
    rows = [(i, 1 + (i * 7919) % 1023) for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, length long")
    n = pack(df, expected_rows=len(rows)).select("sequence_id").distinct().count()
    assert n <= 1.005 * sum(x for _, x in rows) / 1024 + 1


def test_too_long_a_piece():
    with pytest.raises(ValueError, match="does not fit"):
        SumOfSquares(8).place(9)


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}, {"pre_tokenizer": None}, {"model": {"type": "Unigram"}}])
def test_other_tokenizers_raise(change):
    spec = {"model": {"type": "BPE"}, "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}, "added_tokens": []}
    bpe.ByteBpe._check(spec)
    with pytest.raises(ValueError, match="byte-level"):
        bpe.ByteBpe._check({**spec, **change})
