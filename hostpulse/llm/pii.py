"""Personal data in texts: fixed patterns, and a bidirectional LSTM over characters with a CRF for the spellings they miss.

- Base: e-mail addresses, IP addresses, card numbers and phone numbers by pattern. A match that fails its check (parts
  over 255, Luhn, number of digits) is dropped and its characters are not tried again.
- The method learns from a bounded sample of windows around base spans, around other digits and at other places: `SAMPLE` windows of
  `TRAIN_LENGTH` characters of each sort, those with the smallest hashes of the whole corpus. Spans in two further copies of them are respelt
  (` at `, `[dot]`, no plus sign, other separators), so that the network sees forms that no pattern finds. Gates use the softsign
  curve x / (1 + |x|). Forward and backward states give each character a score for each kind; a CRF adds scores for neighbouring kinds.
- Every character of every text is scored, in windows of `LENGTH` that overlap by `OVERLAP`; a character takes its scores from the window
  in which it stands furthest from an edge. Where the score for "none" is so far ahead that no neighbour can change the
  decision, it is decided; the runs of characters between such places are decoded by Viterbi, across windows, which is the
  same as decoding the whole text at once.
- Decoded spans are widened to whole words and numbers. They are added if the digits, parts or name that they hold pass the check of their kind
  (or, for digits, of another one) and they touch no base span.

Null texts count as empty. Repeated rows give repeated results. A corpus without any base span teaches nothing, and nothing is added.
Columns besides the id and the text are ignored; an empty table gives an empty result. Positions are code points. A
very long text is scored in windows and only undecided places are kept, so it needs memory for the text itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hostpulse.llm.common import release, slices, stored, texts_of

KINDS = ("email", "ip", "card", "phone")

#: Windows of each sort that the network learns from, and their length.
SAMPLE = 320
TRAIN_LENGTH = 128
#: Windows that texts are scored in, and what neighbours share.
LENGTH = 512
OVERLAP = 64
#: Windows scored at a time.
BATCH = 1024
#: Cells of each direction, and classes of characters: ASCII, and all others as one.
HIDDEN = 8
CLASSES = 129
#: Largest score of a step between kinds. It bounds what neighbours can change, so that most places are decided by themselves.
MOST_STEP = 0.6

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Starts from each @ instead of trying all starts, so that long runs of letters cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _from_digits(text: str, pattern: re.Pattern) -> Iterator[str]:
    """Matches of a pattern that can only start where a run of digits does."""
    end = 0
    for run in _DIGITS.finditer(text):
        if run.start() >= end and (found := pattern.match(text, run.start())):
            end = found.end()
            yield found


def _parts_fit(parts: list[str]) -> bool:
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _card(digits: str) -> bool:
    return 12 <= len(digits) <= 19 and luhn(digits)


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, number of the kind and end of all spans that the patterns find."""
    spans = [(start, 0, end) for start, end in _emails(text)]
    spans += [(m.start(), 1, m.end()) for m in _from_digits(text, _IP) if _parts_fit(m.group().split("."))]
    spans += [(m.start(), 2, m.end()) for m in _from_digits(text, _CARD) if _card(_digits(m.group()))]
    spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(spans)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# Training


def _codes(text: str) -> np.ndarray:
    """Class of every character."""
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), CLASSES - 1).astype(np.uint8)


def _windows(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Sort, hash, text and marks of windows to learn from: one for each span, one for each other run of digits, and two by hash."""
    spans = base_spans(text)
    marks = bytearray(b"0") * len(text)
    for start, kind, end in spans:
        marks[start:end] = b"%d" % (kind + 1) * (end - start)

    def cut(sort: int, middle: int, seed: int):
        start = max(0, min(middle - TRAIN_LENGTH // 4 - seed % (TRAIN_LENGTH // 2), len(text) - TRAIN_LENGTH))
        window = text[start : start + TRAIN_LENGTH]
        return sort, xxhash.xxh3_64_intdigest(window.encode("utf-8", "surrogatepass")) >> 1, window, marks[start : start + TRAIN_LENGTH].decode()

    for start, kind, end in spans:
        yield cut(kind + 1, start, xxhash.xxh3_64_intdigest(text[start:end].encode()))
    for run in _DIGITS.finditer(text):
        if marks[run.start()] == 48:
            yield cut(5, run.start(), xxhash.xxh3_64_intdigest(run.group().encode()))
    seed = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    if text:
        yield cut(0, seed % len(text), seed >> 32)


def _respelt(window: str, marks: str, turn: int) -> tuple[str, str]:
    """The window with its spans written in ways that the patterns do not know."""
    out, out_marks, place = [], [], 0
    for run in re.finditer(r"1+|2+|3+|4+", marks):
        kind, span = int(marks[run.start()]), window[run.start() : run.end()]
        turn = turn * 5 + 1
        if kind == 1:
            span = span.replace("@", (" at ", "(at)", "[at]", " AT ", " [at] ")[turn % 5])
            span = span.replace(".", (" dot ", ".", "[dot]", "(dot)")[turn % 4])
        elif kind == 2:
            span = span.replace(".", ("[.]", "(.)", " . ", ",")[turn % 4])
        elif kind == 3:
            digits, mark = _digits(span), (".", "/", "  ", "_")[turn % 4]
            span = mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            span = (span.lstrip("+"), "00" + span.lstrip("+"), span.lstrip("+").replace("-", "/"))[turn % 3]
        out += [window[place : run.start()], span]
        out_marks += [marks[place : run.start()], str(kind) * len(span)]
        place = run.end()
    out.append(window[place:])
    out_marks.append(marks[place:])
    return "".join(out)[:TRAIN_LENGTH], "".join(out_marks)[:TRAIN_LENGTH]


def sampled(docs: DataFrame, text: str = "text") -> list[tuple[int, int, str, str]]:
    """At most `SAMPLE` windows of each of six sorts, the same ones however the rows are spread."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [{} for _ in range(6)]
        for batch in batches:
            for one in texts_of(batch):
                for sort, key, window, marks in _windows(one):
                    best[sort][key] = (window, marks)
                    if len(best[sort]) > 4 * SAMPLE:
                        best[sort] = dict(sorted(best[sort].items())[:SAMPLE])
        rows = [(s, key, *found) for s in range(6) for key, found in sorted(best[s].items())[:SAMPLE]]
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.string())
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        yield pa.record_batch(arrays, names=["sort", "key", "window", "marks"])

    rows = docs.select(F.col(text).alias("text"))
    found = stored(rows.mapInArrow(find, "sort int, key bigint, window string, marks string"), "windows")
    chosen = []
    for sort in range(6):
        best = found.where(F.col("sort") == sort).dropDuplicates(["key"]).orderBy("key").limit(SAMPLE)
        chosen += [tuple(row) for row in best.collect()]
    release(found)
    return sorted(chosen)


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(s: np.ndarray) -> np.ndarray:
    """Slope of the softsign where its value is `s`."""
    return (1 - np.abs(s)) ** 2


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _states(model: dict, codes: np.ndarray):
    """Hidden states of both directions, `codes` being (2, batch, time), with all that the way back needs."""
    _, count, length = codes.shape
    h = c = np.zeros((2, count, HIDDEN), np.float32)
    hidden, cells, gates = [], [c], []
    side = np.arange(2)[:, None]
    for t in range(length):
        a = _soft(model["input"][side, codes[:, :, t]] + h @ model["again"])
        a[:, :, : 3 * HIDDEN] = 0.5 + 0.5 * a[:, :, : 3 * HIDDEN]
        i, f, o, z = np.split(a, 4, axis=2)
        c = f * c + i * z
        h = o * _soft(c)
        hidden.append(h)
        cells.append(c)
        gates.append(a)
    return hidden, cells, gates


def _crf(scores: np.ndarray, marks: np.ndarray, sizes: np.ndarray, step: np.ndarray):
    """Log-likelihood and its slopes by scores (batch, time, kinds) and by `step`. Texts start and end next to "none"."""
    count, length, kinds = scores.shape
    rows = np.arange(count)
    inside = np.arange(length)[None] < sizes[:, None]
    ahead = np.empty_like(scores)
    ahead[:, 0] = scores[:, 0] + step[0]
    for t in range(1, length):
        new = _logsum(ahead[:, t - 1, :, None] + step[None], 1) + scores[:, t]
        ahead[:, t] = np.where(inside[:, t, None], new, ahead[:, t - 1])
    total = _logsum(ahead[:, -1] + step[:, 0], 1)
    behind = np.empty_like(scores)
    behind[:, -1] = step[:, 0]
    pairs = np.zeros_like(step)
    for t in range(length - 1, 0, -1):
        new = scores[:, t] + behind[:, t]
        both = ahead[:, t - 1, :, None] + step[None] + new[:, None, :] - total[:, None, None]
        pairs += np.exp(both[inside[:, t]]).sum(0)
        behind[:, t - 1] = np.where(inside[:, t, None], _logsum(step[None] + new[:, None, :], 2), step[:, 0])
    by_score = -np.exp(ahead + behind - total[:, None, None])
    first, last = -by_score[:, 0].sum(0), -by_score[rows, sizes - 1].sum(0)
    by_score[rows[:, None], np.arange(length)[None], marks] += 1
    by_score *= inside[:, :, None]
    by_step = -pairs
    np.add.at(by_step, (marks[:, :-1][inside[:, 1:]], marks[:, 1:][inside[:, 1:]]), 1)
    by_step[0] -= first
    by_step[:, 0] -= last
    np.add.at(by_step[0], marks[:, 0], 1)
    np.add.at(by_step[:, 0], marks[rows, sizes - 1], 1)
    gold = (np.take_along_axis(scores, marks[:, :, None], 2)[:, :, 0] * inside).sum(1) + step[0, marks[:, 0]]
    gold += (step[marks[:, :-1], marks[:, 1:]] * inside[:, 1:]).sum(1) + step[marks[rows, sizes - 1], 0]
    return (gold - total).sum(), by_score, by_step


def fit(windows: list[tuple[int, int, str, str]], rounds: int = 240, group: int = 64, seed: int = 1) -> dict[str, np.ndarray] | None:
    """Weights of the network and the CRF, by Adam on the log-likelihood; None if no window has a span."""
    if not any(sort in (1, 2, 3, 4) for sort, *_ in windows):
        return None
    examples = []
    for sort, key, window, marks in windows:
        examples.append((window, marks))
        if 1 <= sort <= 4:
            examples += [_respelt(window, marks, key % prime) for prime in (1009, 1013)]
    rng = np.random.default_rng(seed)
    k, span = len(KINDS) + 1, 4 * HIDDEN
    model = {
        "input": rng.normal(0, 0.3, (2, CLASSES, span)),
        "again": rng.normal(0, 0.3, (2, HIDDEN, span)),
        "output": rng.normal(0, 0.3, (2, HIDDEN, k)),
        "bias": np.array([2.0] + [0.0] * (k - 1)),
        "step": MOST_STEP * np.eye(k),
    }
    model["input"][:, :, HIDDEN : 2 * HIDDEN] += 1.0
    model = {name: value.astype(np.float32) for name, value in model.items()}
    sizes = np.array([len(window) for window, _ in examples])
    codes = np.zeros((2, len(examples), TRAIN_LENGTH), np.intp)
    marks = np.zeros((len(examples), TRAIN_LENGTH), np.intp)
    for number, (window, mark) in enumerate(examples):
        own = _codes(window)
        codes[0, number, : len(own)], codes[1, number, : len(own)] = own, own[::-1]
        marks[number, : len(own)] = np.frombuffer(mark.encode(), np.uint8) - 48
    first, second = ({name: np.zeros_like(value) for name, value in model.items()} for _ in range(2))
    turned = np.maximum(sizes[:, None] - 1 - np.arange(TRAIN_LENGTH), 0)
    order = np.empty(0, np.intp)
    for turn in range(1, rounds + 1):
        if len(order) < group:
            order = np.concatenate([order, rng.permutation(len(examples))])
        chosen, order = order[:group], order[group:]
        slopes = _slopes(model, codes[:, chosen], marks[chosen], sizes[chosen], turned[chosen])
        rate = 0.03 * min(1, turn / 20) * (1 - 0.95 * turn / rounds)
        for name, slope in slopes.items():
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.99 * second[name] + 0.01 * slope**2
            move = (first[name] / (1 - 0.9**turn)) / (np.sqrt(second[name] / (1 - 0.99**turn)) + 1e-8)
            model[name] = (model[name] + rate * move).astype(np.float32)
        model["step"] = np.clip(model["step"], -MOST_STEP, MOST_STEP)
    return model


def _slopes(model: dict, codes: np.ndarray, marks: np.ndarray, sizes: np.ndarray, turned: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the mean log-likelihood by every weight."""
    count, length = marks.shape
    hidden, cells, gates = _states(model, codes)
    states = np.stack(hidden, 2)  # (2, batch, time, cells)
    ahead, back = states[0], np.take_along_axis(states[1], turned[:, :, None], 1)
    scores = ahead @ model["output"][0] + back @ model["output"][1] + model["bias"]
    inside = (np.arange(length)[None] < sizes[:, None])[:, :, None]
    _, by_score, by_step = _crf(scores.astype(np.float64), marks, sizes, model["step"].astype(np.float64))
    by_score = (by_score / count).astype(np.float32)
    slopes = {
        "step": by_step / count - 1e-3 * model["step"],
        "bias": by_score.sum((0, 1)),
        "output": np.stack([np.einsum("bth,btk->hk", side * inside, by_score) for side in (ahead, back)]),
    }
    by_back = np.take_along_axis(by_score @ model["output"][1].T, turned[:, :, None], 1) * inside
    by_state = np.stack([by_score @ model["output"][0].T, by_back])
    by_gates = np.empty((length, 2, count, 4 * HIDDEN), np.float32)
    dh = dc = np.zeros((2, count, HIDDEN), np.float32)
    for t in range(length - 1, -1, -1):
        i, f, o, z = np.split(gates[t], 4, axis=2)
        curve = _soft(cells[t + 1])
        dh = dh + by_state[:, :, t]
        dc = dc + dh * o * _slope(curve)
        by_gates[t] = np.concatenate(
            [
                0.5 * dc * z * _slope(2 * i - 1),
                0.5 * dc * cells[t] * _slope(2 * f - 1),
                0.5 * dh * curve * _slope(2 * o - 1),
                dc * i * _slope(z),
            ],
            axis=2,
        )
        dc = dc * f
        dh = by_gates[t] @ model["again"].transpose(0, 2, 1)
    before = np.concatenate([np.zeros((1, 2, count, HIDDEN), np.float32), np.stack(hidden[:-1])])
    slopes["again"] = np.einsum("tdbh,tdbg->dhg", before, by_gates, optimize=True)
    flat = by_gates.transpose(1, 2, 0, 3).reshape(2, -1, 4 * HIDDEN)
    onehot = (codes.reshape(2, 1, -1) == np.arange(CLASSES)[None, :, None]).astype(np.float32)
    slopes["input"] = onehot @ flat
    return slopes


# Scoring


def _one_way(inputs: np.ndarray, again: np.ndarray, output: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Scores (time, kinds, batch) of one direction. Cells stand in rows, so every gate is one stretch of memory."""
    length, count = codes.shape
    inputs, again, output = (np.ascontiguousarray(part.T) for part in (inputs, again, output))
    h, c, part = (np.zeros((HIDDEN, count), np.float32) for _ in range(3))
    a, x = (np.empty((4 * HIDDEN, count), np.float32) for _ in range(2))
    scores = np.empty((length, len(output), count), np.float32)
    i, f, o, z = (a[n * HIDDEN : (n + 1) * HIDDEN] for n in range(4))
    opening = a[: 3 * HIDDEN]
    for t in range(length):
        np.take(inputs, codes[t], axis=1, out=x, mode="clip")
        np.matmul(again, h, out=a)
        a += x
        np.abs(a, out=x)
        x += 1
        a /= x
        opening *= 0.5
        opening += 0.5
        c *= f
        np.multiply(i, z, out=part)
        c += part
        np.abs(c, out=part)
        part += 1
        np.divide(c, part, out=h)
        h *= o
        np.matmul(output, h, out=scores[t])
    return scores


def _places(size: int) -> list[int]:
    """Starts of the windows of a text; the last one ends with it."""
    if size <= LENGTH:
        return [0]
    return [*range(0, size - LENGTH, LENGTH - OVERLAP), size - LENGTH]


def _margin(step: np.ndarray) -> float:
    """A lead of "none" beyond this cannot be turned by any neighbours, since it is more than a place's two steps can gain."""
    gain = step[:, 1:, None] + step[None, 1:, :] - step[:, :1, None] - step[None, :1, :]
    return float(gain.max())


def _undecided(model: dict, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Text, place and scores of all places that "none" does not win whatever their neighbours are, in no order."""
    sizes, windows = [len(text) for text in texts], []
    for number, size in enumerate(sizes):
        starts = _places(size) if size else []
        ends = [start + min(LENGTH, size) for start in starts]
        edges = [0, *((a + b) // 2 for a, b in zip(starts[1:], ends)), size]
        windows += [(end - start, number, start, *edges[n : n + 2]) for n, (start, end) in enumerate(zip(starts, ends))]
    # Windows of like length together, so that little is computed beyond their ends.
    windows.sort()
    margin = _margin(model["step"])
    for first in range(0, len(windows), BATCH):
        group = windows[first : first + BATCH]
        length = group[-1][0]
        codes = np.zeros((len(group), length), np.uint8)
        for row, (size, number, start, *_) in enumerate(group):
            codes[row, :size] = _codes(texts[number][start : start + size])
        own = np.array([size for size, *_ in group])
        turned = np.maximum(own - 1 - np.arange(length)[:, None], 0)
        scores = _one_way(model["input"][0], model["again"][0], model["output"][0], np.ascontiguousarray(codes.T).astype(np.intp))
        back = np.take_along_axis(codes.T, turned, 0).astype(np.intp)
        back = _one_way(model["input"][1], model["again"][1], model["output"][1], back)
        scores += back[::-1] if own[0] == length else np.take_along_axis(back, turned[:, None, :], 0)
        scores += model["bias"][:, None]
        lead = scores[:, 0] - scores[:, 1:].max(1)
        start, low, high = (np.array([window[n] for window in group]) for n in (2, 3, 4))
        place = start + np.arange(length)[:, None]
        at, row = np.nonzero((lead <= margin) & (place >= low) & (place < high))
        for t, r in zip(at.tolist(), row.tolist()):
            yield group[r][1], group[r][2] + t, scores[t, :, r]


def _decode(scores: np.ndarray, step: np.ndarray) -> list[int]:
    """The best kinds of a run of places whose neighbours on both sides are "none"."""
    best, last = scores[0] + step[0], []
    for one in scores[1:]:
        ways = best[:, None] + step
        last.append(ways.argmax(0))
        best = ways.max(0) + one
    kinds = [int((best + step[:, 0]).argmax())]
    for back in reversed(last):
        kinds.append(int(back[kinds[-1]]))
    return kinds[::-1]


def _passes(kind: int, span: str) -> bool:
    """The check of a kind, without the pattern's punctuation."""
    if kind == 0:
        halves = re.split(r"@|\bat\b", span, maxsplit=1, flags=re.IGNORECASE)
        tail = re.search(r"(\.|\bdot\b)\W*[A-Za-z]{2,}\W*$", halves[-1], re.IGNORECASE)
        return len(halves) == 2 and tail is not None and any(map(str.isalnum, halves[0]))
    digits = _digits(span)
    if kind == 1:
        return _parts_fit(_DIGITS.findall(span)) and not re.search(r"[^\W\d]", span)
    if kind == 2:
        return _card(digits) and not re.search(r"[^\W\d_]", span)
    return 9 <= len(digits) <= 15 and not re.search(r"[^\W\d_]", span)


def added_spans(model: dict, texts: list[str], known: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """What the method finds in each text beside the spans that are known."""
    found = sorted(_undecided(model, texts), key=lambda one: one[:2])
    spans = [[] for _ in texts]
    step = model["step"].astype(np.float64)
    start = 0
    while start < len(found):
        number, first, _ = found[start]
        end = start + 1
        while end < len(found) and found[end][:2] == (number, first + end - start):
            end += 1
        kinds = _decode(np.array([scores for *_, scores in found[start:end]], np.float64), step)
        for run in re.finditer(r"1+|2+|3+|4+", "".join(map(str, kinds))):
            spans[number].append((first + run.start(), kinds[run.start()] - 1, first + run.end()))
        start = end
    for text, own, base in zip(texts, spans, known):
        kept, place, taken = [], 0, _merged(base)
        for begin, kind, end in own:
            while begin < end and not text[begin].isalnum() and not (kind == 3 and text[begin] == "("):
                begin += 1
            while begin < end and not text[end - 1].isalnum():
                end -= 1
            # No span cuts a word or a number.
            while place < len(taken) and taken[place][1] <= begin:
                place += 1
            least = max(kept[-1][2] if kept else 0, taken[place - 1][1] if place else 0)
            while least < begin < end and text[begin].isalnum() and text[begin - 1].isalnum():
                begin -= 1
            while begin < end < len(text) and text[end].isalnum():
                end += 1
            free = place == len(taken) or taken[place][0] >= end
            # Digits that fail the check of their kind may pass that of another one.
            kinds = [kind, *(other for other in (1, 2, 3) if kind and other != kind)]
            fits = [one for one in kinds if _passes(one, text[begin:end])] if begin < end and free else []
            if fits and begin >= least:
                kept.append((begin, fits[0], end))
        own[:] = kept
    return spans


def _merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans as disjoint stretches in order."""
    out = []
    for start, _, end in spans:
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def train(docs: DataFrame, text: str = "text") -> dict[str, np.ndarray] | None:
    return fit(sampled(docs, text))


def find(docs: DataFrame, model: dict[str, np.ndarray] | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`id_col`, the number of base spans of each kind, the digest of the base spans, all spans, and how many were added."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part)
                base = [base_spans(one) for one in texts]
                more = added_spans(model, texts, base) if model else [[] for _ in texts]
                counts = [pa.array([sum(k == kind for _, k, _ in one) for one in base], pa.int64()) for kind in range(len(KINDS))]
                digests = [hashlib.sha256(written(one).encode()).hexdigest() for one in base]
                spans = [written(sorted(one + new)) for one, new in zip(base, more)]
                added = pa.array([len(new) for new in more], pa.int64())
                yield pa.record_batch([part.column("id"), *counts, pa.array(digests), pa.array(spans), added], names=schema.names)

    schema = T.StructType(
        [rows.schema["id"]]
        + [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS]
        + [T.StructField(name, T.StringType()) for name in ("base_sha256", "spans")]
        + [T.StructField("n_added", T.LongType())]
    )
    return rows.mapInArrow(search, schema).withColumnRenamed("id", id_col)
