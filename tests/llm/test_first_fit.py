import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import pyarrow as pa
from shipyard.llm import word_bpe
from shipyard.llm.bytetext import flat
from shipyard.llm.ffd_packing import close_gaps, first_fit, pack_first_fit, sequences
from shipyard.llm.queries import op12_first_fit_packing
from tests.llm.cases import TEXTS, documents, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["a", "B", "Straße", "'", "'s", "'LL", "'re", "ve", " ", "\n", "\t", "12", "é", "É", "×", "÷", "ß", "Σ", "İ", "́", "é", "漢", "<|endoftext|>", "<|", "|>", "\x00", "\x1c", "\x85", "\xa0", "²", "ª", "-", "?!", "😀", " "]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.lists(st.sampled_from(PIECES), max_size=30).map("".join)), max_size=20))
def test_ids_are_those_of_the_library(texts):
    model = word_bpe.load(PATH)
    ids, at = model.encode(*flat(pa.array(texts, pa.string())))
    expected = model.library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [e.ids for e in expected]


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="not a word BPE"):
        word_bpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))


def brute_first_fit(lengths, capacity):
    room = []
    for n in lengths:
        at = next((k for k, r in enumerate(room) if r >= n), None)
        if at is None:
            room.append(capacity)
            at = len(room) - 1
        room[at] -= n
        yield at


@pytest.mark.parametrize("capacity", [1, 7, 64, 2048])
def test_first_fit_and_closed_gaps(capacity):
    r = random.Random(capacity)
    for _ in range(30):
        lengths = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 300))), reverse=True)
        found = first_fit(lengths, capacity)
        where = {i: k for k, s in enumerate(found) for i, _, _ in s}
        assert [where[i] for i in range(len(lengths))] == list(brute_first_fit(lengths, capacity))
        closed = close_gaps(found, capacity)
        sums = [sum(n for _, _, n in s) for s in closed]
        assert all(0 < n <= capacity and (n == capacity or n & (n - 1) == 0) for n in sums)
        parts = sorted(p for s in closed for p in s)
        assert all(n > 0 for _, _, n in parts)
        for i, n in enumerate(lengths):  # each piece whole, in stretches that follow each other
            mine = [p for p in parts if p[0] == i]
            assert [a for _, a, _ in mine] == np.cumsum([0, *[m for _, _, m in mine]])[:-1].tolist() and sum(m for _, _, m in mine) == n
        assert len(closed) <= len(found) + capacity.bit_length()


def test_pieces_that_do_not_fit_raise():
    with pytest.raises(ValueError, match="does not fit"):
        first_fit([9], 8)


def check(rows, expected, capacity):
    """Exact round trip of (id, token ids) and gapless sequences without padding."""
    docs, filled = {}, {}
    for r in rows:
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"])))
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"]
    for parts in filled.values():
        parts.sort()
        upto = 0
        for offset, n in parts:
            assert offset == upto
            upto += n
        assert upto == capacity or upto & (upto - 1) == 0
    got = sorted((str(i), n, b"".join(x for _, x in sorted(parts))) for (i, n), parts in docs.items())
    assert got == expected


def test_round_trip(spark):
    library = Tokenizer.from_file(PATH)
    texts = [t for t in TEXTS if t[0] is not None and t != TEXTS[8]]
    expected = sorted(
        (str(i), len(ids) + 1, np.array([*ids, 1], "<u4").tobytes())
        for i, ids in ((t[0], library.encode(t[1] or "", add_special_tokens=False).ids) for t in texts)
    )
    packed = pack_first_fit(documents(spark, texts), PATH, capacity=64, group_bytes=1 << 16)
    check(packed.collect(), expected, 64)
    whole = sequences(packed)
    assert whole.where(F.octet_length("ids") != 4 * F.col("n_tokens")).count() == 0
    assert whole.agg(F.sum("n_tokens")).first()[0] == sum(n for _, n, _ in expected)


def test_awkward_rows(spark):
    every = pack_first_fit(documents(spark), PATH)
    assert every.where("start = 0").count() == len(TEXTS)  # repeated rows and null ids, too
    assert every.where("doc_id IS NULL").count() >= 2
    assert pack_first_fit(empty(spark), PATH).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(PATH)
    rows = op12_first_fit_packing(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    covered = dict.fromkeys(texts, 0)
    for r in sorted(rows, key=lambda r: r["start"]):
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert covered[r["doc_id"]] == r["start"] and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        covered[r["doc_id"]] += len(part)
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    assert covered == {i: len(x) for i, x in ids.items()}
