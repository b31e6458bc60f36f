import random

import pytest

from shipyard.llm import substring_dedup
from shipyard.llm.substring_dedup import deep_nodes, remove_repeats
from tests.llm.cases import PASSAGE, TEXTS, documents, empty


def brute(texts, width):
    last = float("inf")
    words = [(last if i is None else i, (t or "").encode().split()) for i, t in texts]
    first = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(i, first.get(key, last))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((None if i == last else i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in df.collect()), key=str)


def test_awkward_documents(spark):
    got = result(remove_repeats(documents(spark), 13))
    assert got == brute([(i, t) for i, t, *_ in TEXTS], 13)
    assert any(r[0] == 2 and r[2] == 20 for r in got) and any(r[0] is None and r[2] == len(PASSAGE.split()) for r in got)
    assert remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("words", [3, 40, 5000])
def test_random_documents(spark, words):
    """With 3 words nearly every prefix is common and long; with 5000 passages are copied."""
    rng = random.Random(words)
    texts = []
    for i in range(120):
        w = [f"w{rng.randrange(words)}" for _ in range(rng.randrange(60))]
        for _ in range(2):
            if texts and rng.random() < 0.6:
                source = rng.choice(texts)[1].split()
                a = rng.randrange(len(source) + 1)
                w[len(w) // 2 : len(w) // 2] = source[a : a + rng.randrange(30)]
        texts.append((rng.randrange(100), " ".join(w)))
    got = remove_repeats(documents(spark, [(i, t, "en", "s") for i, t in texts]), 13)
    assert result(got) == brute(texts, 13)


def test_other_widths_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 300)
    rng = random.Random(9)
    texts = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(40)))) for i in range(60)]
    for width in (6, 8):
        assert result(remove_repeats(documents(spark, [(i, t, "en", "s") for i, t in texts]), width)) == brute(texts, width)
    with pytest.raises(ValueError, match="longer than"):
        remove_repeats(documents(spark), 4)


def test_deep_nodes():
    import numpy as np

    words = np.array([1, 2, 3, 9, 1, 2, 3, 8, 1, 2, 4])
    leaves, first = deep_nodes(words, np.array([0, 1, 4, 8]), 3)
    assert sorted(leaves.tolist()) == [0, 2] and first.tolist() == [0]


def _crowded(n=300):
    """Every window has the words 'a b c d' in front of a number of its own; one passage stands in many contexts."""
    rng = random.Random(4)
    own = lambda: " ".join(f"a b c d {rng.randrange(4000)}" for _ in range(10))
    passage = own()
    return [(i, f"{own()} {passage} {own()}" if i % 3 == 0 else own()) for i in range(n)]


def test_split_groups_give_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", 2000)
    texts = _crowded(120)
    got = result(remove_repeats(documents(spark, [(i, t, "en", "s") for i, t in texts]), 13))
    assert got == brute(texts, 13) and sum(r[2] > 0 for r in got) > 30
    assert result(remove_repeats(documents(spark), 13)) == brute([(i, t) for i, t, *_ in TEXTS], 13)


def _sent(monkeypatch, limit, texts, spark):
    """Bytes of the stretches that each group opens."""
    opened = []
    monkeypatch.setattr(substring_dedup, "GROUP_BYTES", limit)
    send = substring_dedup.stretches_sent

    def kept(*args):
        opened.append(send(*args))
        return opened[-1]

    monkeypatch.setattr(substring_dedup, "stretches_sent", kept)
    got = result(remove_repeats(documents(spark, [(i, t, "en", "s") for i, t in texts]), 13))
    assert got == brute(texts, 13)
    sizes = {}
    for r in opened[0].collect():
        text = substring_dedup._opened(r["blob"])["text"]
        sizes[r["number"]] = sizes.get(r["number"], 0) + sum(len(t.as_py()) for t in text)
    return sizes


def test_a_crowded_prefix_is_split(spark, monkeypatch):
    """What one call of ``answer`` opens stays near the limit, however many windows share a prefix."""
    limit = 20_000
    sizes = _sent(monkeypatch, limit, _crowded(), spark)
    assert sum(sizes.values()) > 10 * limit and max(sizes) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes.values()) < 2 * limit


def test_the_prefix_grows_only_where_it_is_crowded(spark, monkeypatch):
    """Most windows keep the shortest prefix; those behind a frequent phrase have a longer one, few the whole window."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(30000)}"
    phrases = ["in the far north", "one of the many", "as well as all", "it has to be"]
    texts = [(i, " ".join([*[word() for _ in range(60)], phrases[i % 4], *[word() for _ in range(30)]])) for i in range(400)]
    texts += [(1000 + i, texts[i][1]) for i in range(0, 400, 9)]
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 4_000)
    monkeypatch.setattr(substring_dedup, "COMMON", 0.5)
    sizes = _sent(monkeypatch, 14_000, texts, spark)
    groups = -(-sum(len(t) for _, t in texts) // 4_000)
    short = sum(n for g, n in sizes.items() if g < groups)
    grown = sum(n for g, n in sizes.items() if groups <= g < 10 * groups)
    assert short > grown > 0
    assert max(sizes.values()) < 2 * 14_000


def test_growing_prefixes_name_equal_windows_alike():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    shared = " ".join(rng.choice("abcdef") for _ in range(40))
    texts = pa.chunked_array([[f"x y {shared} z", shared, f"{shared} {shared}"]])
    w = substring_dedup.Windows(texts, 7, np.zeros(0, np.uint64), 50)
    rows = [bytes(w.text[w.begin[a] : w.end[a + 6]]) for a in w.at]
    key, every = w.key, np.arange(len(w.at))
    for length in range(4, 8):
        key = w.grown(key, every, length)
        seen = {}
        for row, k in zip(rows, key.tolist(), strict=True):
            assert seen.setdefault(row, k) == k
    # Two windows may only share a whole path if it begins at another word of theirs.
    assert len(set(zip(key.tolist(), (w.anchor - w.at).tolist(), strict=True))) == len(set(rows)) < len(rows)


def test_the_anchor_is_the_first_least_rank_and_common_words_are_found():
    import numpy as np

    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 11, 18):
        order = rng.integers(0, 9, 200).astype(np.uint64)
        got = substring_dedup._least_of(order, n)
        assert [int(x) for x in got[: 200 - n + 1]] == [int(np.argmin(order[i : i + n])) for i in range(200 - n + 1)]
    word = rng.integers(0, 1 << 18, 5000).astype(np.uint64)
    some = np.unique(word[:300])  # more than one of the same low bits
    assert (substring_dedup._among(word, some) == np.isin(word, some)).all()
    assert not substring_dedup._among(word, some[:0]).any()


def test_codes_name_values_in_the_order_in_which_they_come():
    import numpy as np

    from shipyard.llm.bytetext import coded

    values = np.random.default_rng(8).integers(0, 60, 500).astype(np.uint64)
    distinct, place, first = coded(values)
    assert (distinct[place] == values).all() and (values[first] == distinct).all()
    assert [int(x) for x in distinct] == list(dict.fromkeys(values.tolist()))
    assert [len(x) for x in coded(values[:0])] == [0, 0, 0]
