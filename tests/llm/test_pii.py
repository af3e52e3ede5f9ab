"""Base spans against the plain patterns, the network's slopes and windows, and personal data in other spellings."""

import hashlib
import random
import re

import numpy as np
import pytest

from hostpulse.llm import pii

NAMES = "doc_id long, text string, n_email int, spans string, id int, sort int, key int"


def plain(text):
    def digits(found):
        return re.sub("[^0-9]", "", found.group())

    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    found += [(m.start(), 1, m.end()) for m in ips if all(int(p) <= 255 for p in m.group().split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    found += [(m.start(), 2, m.end()) for m in cards if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    return sorted(found + [(m.start(), 3, m.end()) for m in phones if 9 <= len(digits(m)) <= 15])


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def card(rng):
    body = "".join(rng.choices("0123456789", k=15))
    return next(body + d for d in "0123456789" if luhn(body + d))


def datum(rng, kind):
    if kind == 0:
        return f"{rng.choice(['ann', 'bo', 'c.d'])}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.{rng.choice(['com', 'org'])}"
    if kind == 1:
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        return card(rng)
    return f"+{rng.randrange(1, 9)} ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"


def prose(rng, n):
    return " ".join("".join(rng.choices(["an", "er", "tion", "os", "é", "12", "the"], k=rng.randint(1, 3))) for _ in range(n))


def corpus(seed=1, docs=1200):
    """Texts with data of each kind, and texts without any."""
    rng = random.Random(seed)
    return [
        prose(rng, rng.randint(10, 60)) + (f" {datum(rng, i // 2 % 4)} " + prose(rng, 20) if i % 2 else "")
        for i in range(docs)
    ]


def frame(spark, texts, ids=None):
    rows = [(i, t, 7, "x", 1, 2, 3) for i, t in zip(range(len(texts)) if ids is None else ids, texts)]
    return spark.createDataFrame(rows, NAMES).repartition(3)


@pytest.fixture(scope="module")
def model(spark):
    found = pii.train(frame(spark, corpus()))
    return found


@pytest.mark.parametrize("seed", range(6))
def test_base_spans_equal_the_plain_patterns(seed):
    rng = random.Random(seed)
    for _ in range(2000):
        text = "".join(rng.choices(["1", "23", "255", "256", ".", "-", " ", "@", "a", "Z", "+", "(", ")", "_", "%", "é", "١"], k=rng.randint(0, 40)))
        assert pii.base_spans(text) == plain(text)
    text = " and ".join(datum(rng, rng.randrange(4)) for _ in range(50))
    assert pii.base_spans(text) == plain(text) and len(plain(text)) >= 50


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1.." * 150_000, "a@" * 200_000, "+1" + "(" * 400_000, "1 " * 200_000])
def test_long_runs_take_linear_time(text):
    assert pii.base_spans(text) == []


def test_slopes_agree_with_differences():
    rng = np.random.default_rng(2)
    span = 4 * pii.HIDDEN
    shapes = {"input": (2, pii.CLASSES, span), "again": (2, pii.HIDDEN, span), "output": (2, pii.HIDDEN, 5), "bias": (5,), "step": (5, 5)}
    model = {name: rng.normal(0, 0.5, shape).astype(np.float64) for name, shape in shapes.items()}
    sizes = np.array([9, 4, 1])
    codes = np.zeros((2, 3, 9), np.intp)
    marks = rng.integers(0, 5, (3, 9))
    for row, size in enumerate(sizes):
        own = rng.integers(0, 6, size)
        codes[0, row, :size], codes[1, row, :size] = own, own[::-1]
    turned = np.maximum(sizes[:, None] - 1 - np.arange(9), 0)

    def value(changed):
        hidden, _, _ = pii._states(changed, codes)
        states = np.stack(hidden, 2)
        back = np.take_along_axis(states[1], turned[:, :, None], 1)
        scores = states[0] @ changed["output"][0] + back @ changed["output"][1] + changed["bias"]
        return pii._crf(scores.astype(float), marks, sizes, changed["step"])[0] / 3

    slopes = pii._slopes(model, codes, marks, sizes, turned)
    slopes["step"] = slopes["step"] + 1e-3 * model["step"]
    for name, shape in shapes.items():
        for _ in range(6):
            place = tuple(rng.integers(0, n) for n in shape) if name != "input" else (rng.integers(2), rng.integers(6), rng.integers(span))
            up, down = ({k: v.copy() for k, v in model.items()} for _ in range(2))
            up[name][place] += 1e-3
            down[name][place] -= 1e-3
            assert slopes[name][place] == pytest.approx((value(up) - value(down)) / 2e-3, abs=2e-4)


def test_decoding_equals_all_paths():
    rng = np.random.default_rng(4)
    for _ in range(50):
        scores, step = rng.normal(0, 2, (4, 5)), rng.normal(0, 1, (5, 5))

        def total(path):
            way = [0, *path, 0]
            return sum(scores[i, k] for i, k in enumerate(path)) + sum(step[a, b] for a, b in zip(way, way[1:]))

        best = max((total(path), path) for path in np.ndindex(5, 5, 5, 5))[1]
        assert pii._decode(scores, step) == list(best)


def test_runs_between_decided_places_are_decoded_as_the_whole(model):
    """One Viterbi over all scores of a text, without deciding any place beforehand."""
    texts = [t for t in corpus(9, 40)] + [prose(random.Random(5), 600) + " ann at mail dot example dot com " + prose(random.Random(6), 300)]
    open_model = dict(model)
    everything = {}
    margin = pii._margin
    pii._margin = lambda step: np.inf
    try:
        for number, place, scores in pii._undecided(open_model, texts):
            everything[number, place] = scores
    finally:
        pii._margin = margin
    for number, text in enumerate(texts):
        scores = np.array([everything[number, place] for place in range(len(text))], np.float64)
        kinds = pii._decode(scores, model["step"].astype(float))
        found = {place: one for n, place, one in pii._undecided(model, [text])}
        assert all(kinds[place] == 0 for place in range(len(text)) if place not in found)
        # A text alone or among others, its scores are the same but for rounding.
        for place, one in found.items():
            assert np.allclose(one, scores[place], atol=1e-4)


def test_adds_other_spellings_and_leaves_clean_texts_alone(spark, model):
    rng = random.Random(77)
    texts, wanted = [], []
    for number in range(200):
        kind = number % 4
        span = datum(rng, kind)
        if kind == 0:
            span = span.replace("@", " at ").replace(".", " dot ")
        elif kind == 1:
            span = span.replace(".", "[.]")
        elif kind == 2:
            span = ".".join(span[i : i + 4] for i in range(0, 16, 4))
        else:
            span = span.lstrip("+")
        before = prose(rng, 30)
        texts.append(f"{before} {span} {prose(rng, 30)}")
        wanted.append((kind, len(before) + 1, len(before) + 1 + len(span)))
    clean = [prose(rng, rng.randint(1, 400)) for _ in range(200)]
    rows = pii.find(frame(spark, texts + clean), model).orderBy("doc_id").collect()
    hit = [0] * 4
    for row, (kind, start, end) in zip(rows, wanted):
        assert row.base_sha256 == hashlib.sha256(pii.written(pii.base_spans(texts[row.doc_id])).encode()).hexdigest()
        spans = [one.split(":") for one in row.spans.split(",") if one]
        hit[kind] += any(name == pii.KINDS[kind] and min(int(e), end) - max(int(s), start) > 0.8 * (end - start) for name, s, e in spans)
    assert min(hit) >= 40
    assert sum(row.n_added for row in rows[200:]) <= 2


def test_odd_rows(spark, model):
    data = "ann.3@mail.example.com, 1.2.3.4, 4111 1111 1111 1111, +1 (017) 555-7713"
    long = prose(random.Random(1), 60_000) + " " + data
    texts = [None, "", data, data, long, "é" * 700, "x"]
    rows = pii.find(frame(spark, texts, [1, 2, 3, 3, None, 5, None]), model).collect()
    assert len(rows) == 7 and rows[0].asDict().keys() == {
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"
    }
    found = sorted((row.n_email, row.n_ip, row.n_card, row.n_phone) for row in rows)
    assert found == [(0, 0, 0, 0)] * 4 + [(1, 1, 1, 1)] * 3
    assert sum(row.spans.startswith("email:0:22,ip:24:31,card:33:52,phone:54:71") for row in rows) == 2
    empty = frame(spark, texts).limit(0)
    assert pii.train(empty) is None and pii.find(empty, None).count() == 0
    assert pii.train(frame(spark, [None, "", "no data at all"])) is None
    assert [row.spans for row in pii.find(frame(spark, [data]), None).collect()][0].count(":") == 8


def test_sample_does_not_depend_on_the_spread(spark):
    rows = frame(spark, corpus(3, 120))
    assert pii.sampled(rows.coalesce(1)) == pii.sampled(rows.repartition(7))
