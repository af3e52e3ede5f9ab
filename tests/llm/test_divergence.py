"""The audit against plain counting, and on rows that are null, empty, repeated or very long."""

import collections
import random
import re

import numpy as np
import pytest

from hostpulse.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
NAMES = "doc_id int, text string, lang string, source string, term string, n int, block int, total int"


def expected(rows, least=10):
    """Part by part from the definition, with Python's integers."""
    docs = collections.defaultdict(collections.Counter)
    counts = collections.defaultdict(collections.Counter)
    for lang, source, text in rows:
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in sorted({lang for lang, _ in counts}):
        kept = sorted(w for w, n in docs[lang].items() if n >= least)
        sources = sorted(source for of, source in counts if of == lang)

        def shares(count):
            total = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 2) // (total + 2 * len(kept)) for w in kept}

        def value(p, q):
            return (p - q) ** 2 // (p + q)

        p = {s: shares(counts[lang, s]) for s in sources}
        whole = shares(sum((counts[lang, s] for s in sources), collections.Counter()))
        for s in sources:
            found = [(-sum(value(p[s][w], p[o][w]) for w in kept), o.encode()) for o in sources if o != s]
            out += [(lang, s, "pair", o.decode(), -v, rank) for rank, (v, o) in enumerate(sorted(found), 1)]
            found = [(-value(p[s][w], whole[w]), w.encode()) for w in kept if counts[lang, s][w] and p[s][w] > whole[w]]
            out += [(lang, s, "term", w.decode(), -v, rank) for rank, (v, w) in enumerate(sorted(found)[:10], 1)]
    return sorted(out)


def audited(spark, rows, **options):
    table = [(i, t, la, s, "term", 7, 8, 9) for i, (la, s, t) in enumerate(rows)]
    found = divergence.audit(spark.createDataFrame(table, NAMES).repartition(3), **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, found.collect()))


def corpus(seed, sources, docs=400):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéßÄZ漢", k=rng.randint(1, 4))) for _ in range(150)]
    rows = []
    for _ in range(docs):
        # A third of all rows have one source, and the sources prefer different words.
        number = rng.randrange(sources) if rng.random() > 1 / 3 else 0
        chosen = rng.choices(vocabulary, weights=[1 + (i + number) % 7 for i in range(150)], k=rng.randint(0, 60))
        rows.append((rng.choice(["en", "de", None]), f"s{number}", rng.choice([" ", "\n", "-", "7"]).join(chosen)))
    return rows


def test_equals_plain_counting(spark):
    rows = corpus(1, 6)
    rows += [("en", "s1", None), (None, None, None), ("en", "empty", ""), ("xx", "a", "rare words"), ("xx", "b", None), ("en", "s2", "A a\x00É" * 5)]
    assert audited(spark, rows) == expected(rows)


def test_more_groups_than_a_tile_and_more_terms_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "BLOCK", 11)
    rows = corpus(2, 8)
    assert audited(spark, rows, least_docs=2) == expected(rows, 2)


def test_flushed_counts_and_cut_texts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "ENTRIES", 20)
    monkeypatch.setattr(divergence, "SLICE_BYTES", 64)
    rows = corpus(3, 3, 60) + [("en", "s0", "ab " * 40_000), ("en", "s0", "x" * 50_000)] * 10
    assert audited(spark, rows) == expected(rows)


def test_no_rows_and_no_kept_term(spark):
    assert audited(spark, []) == []
    rows = [("en", "a", "one"), ("en", "b", None), ("en", "b", "two two")]
    assert audited(spark, rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_equal_subtrees_are_one_node():
    leaves = np.array([[0, 0, 0, 0, 1, 2, 0, 0], [0, 0, 1, 2, 0, 0, 0, 0]])
    forest = divergence.Forest(leaves)
    assert [len(left) for left, _ in forest.levels] == [2, 3, 2]
    walks, a, b, times = forest.walk(np.array([0]), np.array([1]))
    met = collections.Counter(zip(leaves[0].tolist(), leaves[1].tolist()))
    assert {(x, y): n for x, y, n in zip(a.tolist(), b.tolist(), times.tolist())} == met and set(walks) == {0}


def test_shares_beyond_64_bits():
    assert divergence.shares([10**13, 0], 10**13, 2) == [1 + 10**9 * (10**13 + 2) // (10**13 + 4), 1]


@pytest.mark.parametrize("text", [b"", b"abc", b"ab " * 10, b"x" * 100])
def test_pieces_keep_all_words(text, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 8)
    assert [w for piece in divergence._pieces(text) for w in piece.split()] == text.split()
