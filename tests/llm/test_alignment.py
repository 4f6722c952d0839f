"""Links and groups of two tokenizers against a plain walk over bytes."""

import collections
import hashlib
import random

import numpy as np
import pytest

from strata.llm import alignment
from tests.llm import cases

KNOWN = alignment.Tokenizers(alignment.FOLDER)
TEXTS = [
    "Plain words, 12 numbers", "  leading and   many blanks \n\n", "über größere Äpfel", "日本語のテキスト", "<s> <|endoftext|> </s> <0x41>",
    "▁ is not a blank", "á ﬁ \U0001f600\U0001f468‍\U0001f469", "x", " ", "\t", "don't we'll", "\x00\x7f", "a" * 300,
]


def walk(text):
    """Links as token numbers and groups, byte by byte."""
    a = KNOWN.a.encode(" " + text, add_special_tokens=False).ids
    b = KNOWN.b.encode(text)
    whole = (" " + text).encode()
    if not text or b"".join(KNOWN.a_bytes[i] for i in a) != whole or b"".join(KNOWN.b_bytes[i] for i in b) != whole:
        return [], [], [], []
    owner = [[k for k, i in enumerate(ids) for _ in known[i]] for ids, known in ((a, KNOWN.a_bytes), (b, KNOWN.b_bytes))]
    links = sorted(set(zip(*owner)))
    groups, now = [], (set(), set())
    for at, (x, y) in enumerate(zip(*owner)):
        now[0].add(x), now[1].add(y)
        last = at + 1 == len(whole)
        if last or (owner[0][at + 1] != x and owner[1][at + 1] != y):
            groups.append(([a[i] for i in sorted(now[0])], [b[i] for i in sorted(now[1])]))
            now = (set(), set())
    return a, b, links, groups


def brute(rows):
    found = [walk(r[1] or "") for r in rows]
    counts = collections.Counter((a[x], b[y]) for a, b, links, _ in found for x, y in links)
    highest = collections.Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for row, (a, b, links, groups) in zip(rows, found):
        held = [counts[a[x], b[y]] for x, y in links]
        best = sum(counts[a[x], b[y]] == highest[b[y]] for x, y in links)
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((row[0], len(a), len(b), len(groups), len(links), best, sum(held), digest))
    return sorted(out, key=repr)


def sample_rows():
    rng, words = random.Random(3), " ".join(TEXTS).split()
    texts = [*TEXTS, *[" ".join(rng.choices(words, k=rng.randrange(1, 60))) for _ in range(40)]]
    return [cases.document(1000 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("most", [alignment.FREQUENT, 40, 0])
def test_counts_equal_a_plain_walk(spark, most):
    rows = sample_rows() + [r for r in cases.messy_rows() if len(r[1] or "") < 10_000]
    docs = spark.createDataFrame(rows, cases.SCHEMA).repartition(3)
    got = alignment.aligned(docs, most=most)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_groups_are_those_of_the_digest(spark):
    rows = sample_rows()
    for r in alignment.linked(spark.createDataFrame(rows, cases.SCHEMA), groups=True).collect():
        groups = walk(rows[r["doc_id"] - 1000][1])[3]
        assert [(g["a"], g["b"]) for g in r["groups"]] == groups


@pytest.mark.parametrize("work", [1, 2, 3, 7, 1000])
def test_pieces_do_not_change_the_merge(work):
    rng = np.random.default_rng(work)
    for _ in range(60):
        total = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, total + 1, rng.integers(0, 30)), total)) for _ in range(2))
        i, j = alignment.diagonals(a, b, work)
        assert (np.diff(i + j)[:-1] == work).all() and i[-1] == len(a) and j[-1] == len(b)
        link_a, link_b, a_shared, b_shared = alignment.merged(a, b, work)
        want = sorted({(int(np.searchsorted(a, p)), int(np.searchsorted(b, p))) for p in range(1, total + 1)})
        assert list(zip(link_a.tolist(), link_b.tolist())) == want
        assert a[a_shared].tolist() == b[b_shared].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_long_texts_are_cut_where_no_token_crosses(monkeypatch):
    rng = random.Random(8)
    words = "don't stop, the Äpfel 12 x's we'll go on  and\non 日本 text".split(" ")
    text = " ".join(rng.choices(words, k=3000))
    whole = KNOWN.encoded([text])[0]
    monkeypatch.setattr(alignment, "CUT_CHARS", 50)
    assert len(KNOWN.parts(text)) > 100
    cut = KNOWN.encoded([text])[0]
    assert KNOWN.cuttable and all((x == y).all() for x, y in zip(whole, cut)) and len(whole[0])


class Counting:
    """A tokenizer that notes how many characters it is given."""

    def __init__(self, inner):
        self.inner, self.seen = inner, 0

    def encode(self, texts, **options):
        self.seen += sum(map(len, texts))
        return self.inner.encode(texts, **options)

    def encode_batch_fast(self, texts, **options):
        self.seen += sum(map(len, texts))
        return self.inner.encode_batch_fast(texts, **options)


def test_a_word_is_tokenised_once(monkeypatch):
    KNOWN.forget()
    text = " ".join(f"word{i % 10} Äpfel" for i in range(5000))
    a, b = Counting(KNOWN.a), Counting(KNOWN.b)
    monkeypatch.setattr(KNOWN, "a", a)
    monkeypatch.setattr(KNOWN, "b", b)
    first, other = KNOWN.encoded([text, text[::-1]]), KNOWN.encoded([text])
    assert a.seen < 500 and b.seen < 500
    assert (first[0][0] == other[0][0]).all() and (first[0][1] == other[0][1]).all()


@pytest.mark.parametrize("kept, slab", [(alignment.KEPT_CHARS, alignment.TEXT_BYTES), (30, 1), (0, 100)])
def test_tokens_of_words_are_those_of_the_text(monkeypatch, kept, slab):
    monkeypatch.setattr(alignment, "KEPT_CHARS", kept)
    monkeypatch.setattr(alignment, "TEXT_BYTES", slab)
    rng = random.Random(kept)
    pieces = ["a", "Z9", "Ä", "日本", "'s", "n't", "12", ".", "|", "▁", "x▁y", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\u2009", "\x85",
              "\x1c", "\u180e", "\u200b", "\u0301", "\U0001f600", "\x00", "<s>", "<|endoftext|>"]
    texts = ["", None, *["".join(rng.choice(pieces) + " " * rng.choice([0, 1, 1, 1, 2]) for _ in range(rng.randrange(1, 30)))
                         for _ in range(400)]]
    given = 0
    for text, (got_a, got_b) in zip(texts, KNOWN.encoded(texts)):
        a, b, _, _ = walk(text or "")
        assert (got_a.tolist(), got_b.tolist()) == (a, b)
        given += len(a) > 0
    assert 20 < given < 400


def test_an_error_leaves_no_half_learned_words(monkeypatch):
    KNOWN.forget()
    KNOWN.encoded(["first words"])
    with monkeypatch.context() as broken:
        broken.setattr(KNOWN, "b", None)
        with pytest.raises(AttributeError):
            KNOWN.encoded(["words that fail"])
    a, b, _, _ = walk("that fail first")
    assert [x.tolist() for x in KNOWN.encoded(["that fail first"])[0]] == [a, b]


def test_messy_and_empty(spark):
    got = {r["doc_id"]: r for r in alignment.aligned(cases.messy(spark)).collect()}
    assert got[1]["n_a"] == got[2]["n_b"] == 0 and got[1]["groups_sha256"] == ""
    assert got[5]["n_links"] > 100_000
    assert alignment.aligned(cases.empty(spark)).collect() == []
