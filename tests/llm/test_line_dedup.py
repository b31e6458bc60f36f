import hashlib
import random

from shipyard.llm.line_dedup import DIVISOR, MODULUS, MULTIPLIER, remove_repeated_chunks
from tests.llm.cases import CLASHES, TEXTS, documents, empty


def cut(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    raw = [i == 0 or (h[i - 1] * MULTIPLIER + h[i]) % MODULUS % DIVISOR == 0 for i in range(len(lines))]
    out, start = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or (0 < i < len(lines) - 2 and raw[i] and not raw[i - 1]):
            out.append("\n".join(lines[start : i + 1]))
            start = i + 1
    return out


def brute(texts):
    last, first = float("inf"), {}
    places = []
    for i, t in texts:
        for k, c in enumerate(cut(t) if t is not None else []):
            if "\n" in c and c.strip(" \t\r\n"):
                place = (last if i is None else i, k)
                first[c] = min(place, first.get(c, place))
                places.append((i, t, k, c, place))
    gone = {(i, t, k) for i, t, k, c, place in places if place > first[c]}
    out = []
    for i, t in texts:
        if t is None:
            out.append((i, None, None, None))
        else:
            parts = cut(t)
            out.append((i, "\n".join(c for k, c in enumerate(parts) if (i, t, k) not in gone), len(parts), sum((i, t, k) in gone for k in range(len(parts)))))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["text"], r["n_chunks"], r["n_removed_chunks"]) for r in df.collect()), key=str)


def test_awkward_documents(spark):
    docs = documents(spark)
    got = remove_repeated_chunks(docs)
    assert result(got) == brute([(i, t) for i, t, *_ in TEXTS])
    assert got.columns == [c for c in docs.columns if c != "n_chunks"] + ["n_chunks", "n_removed_chunks"]
    for r in got.collect():
        assert all(r[c] == (r["doc_id"] or 0) for c in CLASHES if c != "n_chunks")
    assert remove_repeated_chunks(empty(spark)).count() == 0


def test_random_lines(spark):
    rng = random.Random(2)
    passage = [f"passage line {i}" for i in range(12)]
    texts = []
    for i in range(150):
        lines = [rng.choice(["hot line", "", f"line {rng.randrange(400)}"]) for _ in range(rng.randrange(25))]
        if rng.random() < 0.5:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = passage
        texts.append((rng.randrange(140), "\n".join(lines)))
    got = remove_repeated_chunks(documents(spark, [(i, t, "en", "s") for i, t in texts]))
    want = brute(texts)
    assert result(got) == want and sum(w[3] for w in want) > 50


def test_boundaries_move_with_the_text():
    body = [f"body {i}" for i in range(200)]
    a, b = cut("\n".join(body)), cut("\n".join(["new first line", *body]))
    assert len(set(a) & set(b)) >= len(a) - 2 and "\n".join(a) == "\n".join(body)
    assert all("\n" in c for c in a)
