"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

Lines are described by yes-or-no features of their words and letters. A label says of a whole document whether it is good, so
it fixes no line's mark, only on which side of `CONTENT_SHARE` the words on content lines lie. The field is trained in turns: maximum
likelihood for given marks, then Viterbi marks under that constraint. So that the field learns what a change of marks
looks like, half of what it sees are planted sequences: a bad document put between two parts of a good one, and the reverse.
Viterbi decoding finds the likeliest sequence of marks of the whole document. A document is kept if it passes the base rules and at
least `CONTENT_SHARE` of its words stand on content lines.

Null and empty texts have no words and so fail the base rules. Repeated rows give repeated results; columns
besides the id and the text are ignored. Of labelled rows that share an id one is learnt from. Without labelled rows every line
counts as content.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostpulse.llm import common

#: Most labelled documents that the field is fitted on: those with the smallest hash of the id.
TRAINING_DOCUMENTS = 2000
#: Most lines that the field learns from in each of them: a run of lines at a place that the id decides.
TRAINING_LINES = 256
#: Turns of finding weights for marks and marks for weights.
TURNS = 2
CONTENT_SHARE = 0.5
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

FEATURES = (
    "any",
    "no word",
    "under 3 words",
    "under 10 words",
    "symbols: 1 in 10 letters",
    "symbols: 1 in 4 words",
    "upper case: half of all letters",
    "exclamation marks: 1 in 3 words",
    "bars: 1 in 5 words",
    "word repeats the one before: 1 in 4",
    "equal to an earlier line",
    "digits: 1 in 5 letters",
    "ends a sentence",
    "in repeated windows: 1 in 3 words",
    "in repeated windows: any word",
    "few letters: 1 in 2",
)

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True


def _class(letters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(letters)] = True
    return table


_SYMBOL = _class(b"#*$%&|<>")
_UPPER = _class(bytes(range(65, 91)))
_LETTER = _class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_DIGIT = _class(b"0123456789")


class Lines:
    """The lines of several texts, with what the rules and the field need to know of them, found in a few array passes."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        # Each text is followed by a line end, so that the last line of one never runs into the next text.
        data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        text_starts = np.cumsum(np.r_[0, sizes + 1])[:-1]
        blank = _BLANK[data]
        newline = data == 10
        line_ends = np.flatnonzero(newline)
        line_starts = np.r_[0, line_ends[:-1] + 1][: len(line_ends)]
        word_starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]][: len(blank)])
        self.n_texts, self.n_lines = len(texts), len(line_ends)
        self.line_text = np.searchsorted(text_starts, line_starts, "right") - 1
        self.word_line = np.searchsorted(line_starts, word_starts, "right") - 1
        self.word_text = self.line_text[self.word_line]
        self.words = np.bincount(self.word_text, minlength=len(texts))
        self.line_words = np.bincount(self.word_line, minlength=self.n_lines)

        def per_line(marks: np.ndarray) -> np.ndarray:
            sums = np.r_[0, np.cumsum(marks, dtype=np.int64)]
            return sums[line_ends] - sums[line_starts]

        def per_text(marks: np.ndarray) -> np.ndarray:
            sums = np.r_[0, np.cumsum(marks, dtype=np.int64)]
            return sums[text_starts + sizes] - sums[text_starts]

        symbol = _SYMBOL[data]
        self.chars = per_text(~blank & ((data & 0xC0) != 0x80))
        self.symbols = per_text(symbol)
        self.duplicate = self._duplicates(texts)
        self.duplicates = np.bincount(self.line_text, self.duplicate, len(texts)).astype(np.int64)
        codes = self._codes(texts)
        repeated = self._repeated(codes)
        self.repeated = np.bincount(self.word_text, repeated, len(texts)).astype(np.int64)

        again = np.r_[False, codes[1:] == codes[:-1]][: len(codes)]
        again[np.flatnonzero(np.diff(self.word_line, prepend=-1))] = False
        words, letters = self.line_words, per_line(_LETTER[data])
        chars = per_line(~blank)
        share = lambda marks: np.bincount(self.word_line, marks, self.n_lines)
        last = data[np.maximum(line_ends - 1, 0)]
        symbols, upper = per_line(symbol), per_line(_UPPER[data])
        self.features = np.stack(
            [
                np.ones(self.n_lines, bool),
                words == 0,
                words < 3,
                words < 10,
                (symbols * 10 >= chars) & (chars > 0),
                (symbols * 4 >= words) & (words > 0),
                (upper * 2 >= letters) & (letters > 0),
                (per_line(data == 33) * 3 >= words) & (words > 0),
                (per_line(data == 124) * 5 >= words) & (words > 0),
                (share(again) * 4 >= words) & (words > 0),
                self.duplicate,
                (per_line(_DIGIT[data]) * 5 >= chars) & (chars > 0),
                np.isin(last, [33, 46, 63]) & (words > 0),
                (share(repeated) * 3 >= words) & (words > 0),
                share(repeated) > 0,
                (letters * 2 <= chars) & (chars > 0),
            ],
            axis=1,
        )

    def _duplicates(self, texts: list[bytes]) -> np.ndarray:
        """Lines with a word that are equal to an earlier line of their text."""
        marks, at = np.zeros(self.n_lines, bool), 0
        for text in texts:
            lines = text.split(b"\n")
            if len(set(lines)) < len(lines):
                seen = set()
                for number, line in enumerate(lines, at):
                    marks[number] = line in seen
                    seen.add(line)
            at += len(lines)
        return marks & (self.line_words > 0)

    def _codes(self, texts: list[bytes]) -> np.ndarray:
        """A number for each word, equal for equal words."""
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        return np.fromiter(
            (numbers[word] for text in texts for word in text.split()), np.int64, len(self.word_text)
        )

    def _repeated(self, codes: np.ndarray) -> np.ndarray:
        """Words in windows of `WINDOW` words that their text has twice or more."""
        marks = np.zeros(len(codes), bool)
        if len(codes) < WINDOW:
            return marks
        # Pairs of windows are numbered again and again: 2, 4, then 8 words, without hashing.
        numbers, width = codes, 1
        while width < WINDOW:
            pairs = numbers[:-width] * np.int64(1 << 31) + numbers[width:]
            numbers = np.unique(pairs, return_inverse=True)[1]
            width *= 2
        starts = np.arange(len(numbers))
        inside = self.word_text[starts] == self.word_text[starts + WINDOW - 1]
        starts = starts[inside]
        keys = numbers[inside] * np.int64(self.n_texts) + self.word_text[starts]
        _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
        starts = starts[counts[place] > 1]
        cover = np.zeros(len(codes) + 1, np.int64)
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + WINDOW, -1)
        return np.cumsum(cover[:-1]) > 0

    def failed(self) -> np.ndarray:
        return (self.words < MIN_WORDS) | (100 * self.repeated > MAX_REPEATED_PERCENT * self.words)


class Field:
    """A linear-chain conditional random field with two marks: 0 boilerplate, 1 content."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray):
        self.emission, self.transition = emission, transition  # (features, 2), (2, 2)

    def viterbi(self, features: np.ndarray, lean: float = 0.0) -> list[int]:
        """The likeliest marks of one sequence; content where both are equally likely. `lean` is added for content on each line."""
        if not len(features):
            return []
        (t00, t01), (t10, t11) = self.transition.tolist()
        scores = (features @ self.emission + [0.0, lean]).tolist()
        a, b = scores[0]
        back = []
        for x, y in scores[1:]:
            stay0, stay1 = a + t00 > b + t10, b + t11 >= a + t01
            back.append((0 if stay0 else 1, 1 if stay1 else 0))
            a, b = (a + t00 if stay0 else b + t10) + x, (b + t11 if stay1 else a + t01) + y
        mark = int(b >= a)
        marks = [mark]
        for pair in reversed(back):
            mark = pair[mark]
            marks.append(mark)
        return marks[::-1]


def fit(sequences: list[np.ndarray], marks: list, rounds: int = 150, decay: float = 1e-3) -> Field:
    """Maximum likelihood with a small penalty, by Adam. Marks are one for each line, or one for all lines of a sequence.

    All sequences advance together, one line at a time, the longest first.
    """
    width = sequences[0].shape[1]
    emission, transition = np.zeros((width, 2)), np.zeros((2, 2))
    order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
    lengths = np.array([len(sequences[k]) for k in order])
    gold = [np.broadcast_to(np.asarray(marks[k], np.int64), len(sequences[k])) for k in order]
    active = [int((lengths > t).sum()) for t in range(lengths[0])]
    steps = [np.stack([sequences[k][t] for k in order[:n]]).astype(float) for t, n in enumerate(active)]
    total = lengths.sum()
    seen_emission, seen_transition = np.zeros_like(emission), np.zeros_like(transition)
    for t, n in enumerate(active):
        now = np.array([line[t] for line in gold[:n]])
        for mark in (0, 1):
            seen_emission[:, mark] += steps[t][now == mark].sum(axis=0)
        if t:
            np.add.at(seen_transition, ([line[t - 1] for line in gold[:n]], now), 1)
    moments = [np.zeros(width * 2 + 4), np.zeros(width * 2 + 4)]
    for turn in range(1, rounds + 1):
        scores = [step @ emission for step in steps]
        forward = [scores[0]]
        for t, n in enumerate(active[1:], 1):
            forward.append(np.logaddexp.reduce(forward[-1][:n, :, None] + transition, axis=1) + scores[t])
        hoped_emission, hoped_transition = np.zeros_like(emission), np.zeros_like(transition)
        backward = np.zeros((active[-1], 2))
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            if len(backward) < n:
                backward = np.vstack([backward, np.zeros((n - len(backward), 2))])
            joint = forward[t] + backward
            norm = np.logaddexp.reduce(joint, axis=1)
            hoped_emission += steps[t].T @ np.exp(joint - norm[:, None])
            if t:
                behind = scores[t] + backward
                edge = forward[t - 1][:n, :, None] + transition + behind[:, None, :]
                hoped_transition += np.exp(edge - norm[:, None, None]).sum(axis=0)
                backward = np.logaddexp.reduce(transition + behind[:, None, :], axis=2)
        slope = np.r_[
            ((seen_emission - hoped_emission) / total - decay * emission).ravel(),
            ((seen_transition - hoped_transition) / total - decay * transition).ravel(),
        ]
        moments[0] = 0.9 * moments[0] + 0.1 * slope
        moments[1] = 0.99 * moments[1] + 0.01 * slope**2
        step = 0.2 * (moments[0] / (1 - 0.9**turn)) / (np.sqrt(moments[1] / (1 - 0.99**turn)) + 1e-9)
        emission = emission + step[: width * 2].reshape(width, 2)
        transition = transition + step[width * 2 :].reshape(2, 2)
    return Field(emission, transition)


def constrained(field: Field, features: np.ndarray, words: np.ndarray, good: int) -> np.ndarray:
    """The likeliest marks that agree with the label: at least `CONTENT_SHARE` of the words on content lines if good, else less."""
    lean = 0.0
    while True:
        marks = np.array(field.viterbi(features, lean), np.int64)
        if ((marks @ words >= CONTENT_SHARE * words.sum()) == bool(good)) or abs(lean) > 64:
            return marks
        lean = (2 * abs(lean) or 0.5) * (1 if good else -1)


def planted(sequences: list[np.ndarray], marks: list[np.ndarray], labels: list[int]) -> tuple[list, list]:
    """Each sequence of the rarer label between two parts of one of the other label, and the reverse, with their marks."""
    kinds = [[k for k, label in enumerate(labels) if label == kind] for kind in (0, 1)]
    few, many = sorted(kinds, key=len)
    rng = np.random.default_rng(len(labels))
    found, given = [], []
    for inner, outer in zip(few, rng.permutation(many)):
        for x, y in ((inner, outer), (outer, inner)):
            at = int(rng.integers(0, len(sequences[y]) + 1))
            for out, parts in ((found, sequences), (given, marks)):
                out.append(np.concatenate([parts[y][:at], parts[x], parts[y][at:]]))
    return found, given


def learn(sequences: list[np.ndarray], words: list[np.ndarray], labels: list[int], turns: int = TURNS) -> Field:
    """A field from the lines' features, their numbers of words and the documents' labels. Marks start as the labels."""
    marks = [np.full(len(rows), label, np.int64) for rows, label in zip(sequences, labels)]
    for turn in range(turns):
        more, given = planted(sequences, marks, labels)
        field = fit([*sequences, *more], [*marks, *given])
        if turn + 1 < turns:
            marks = [constrained(field, *row) for row in zip(sequences, words, labels)]
    return field


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    limit: int = TRAINING_DOCUMENTS,
    lines: int = TRAINING_LINES,
) -> Field:
    """A field fitted on at most `limit` labelled documents, at most `lines` lines of each. No text reaches the driver."""
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.max(label_col).cast("int").alias("mark"))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(limit)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, text_col):
                found = Lines(common.bytes_of(part, text_col))
                stops = np.searchsorted(found.line_text, np.arange(found.n_texts + 1)).tolist()
                rows, words = [], []
                for a, b, place in zip(stops, stops[1:], part.column("place").to_pylist()):
                    a += place % max(1, b - a - lines + 1)
                    b = min(b, a + lines)
                    rows.append(np.packbits(found.features[a:b], axis=1).tobytes())
                    words.append(found.line_words[a:b].astype(np.int32).tobytes())
                columns = [part.column("key"), part.column("mark"), pa.array(rows, pa.binary()), pa.array(words, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "mark", "rows", "words"])

    # At most `limit` ids: a bounded broadcast. Of rows that share an id the one with the smallest features stays.
    key = F.col(id_col).cast("string")
    found = (
        docs.select(id_col, text_col)
        .join(F.broadcast(chosen), id_col)
        .select(key.alias("key"), "mark", (F.xxhash64(key).bitwiseAND((1 << 62) - 1)).alias("place"), text_col)
        .mapInArrow(run, "key string, mark int, rows binary, words binary")
        .groupBy("key")
        .agg(F.min(F.struct("rows", "words", "mark")).alias("one"))
        .select("one.*")
        .orderBy("rows", "words", "mark")
        .collect()
    )
    width = len(FEATURES)
    sequences = [
        np.unpackbits(np.frombuffer(row.rows, np.uint8).reshape(-1, (width + 7) // 8), axis=1)[:, :width]
        for row in found
    ]
    if not sequences:
        return Field(np.zeros((width, 2)), np.zeros((2, 2)))
    return learn(sequences, [np.frombuffer(row.words, np.int32) for row in found], [row.mark for row in found])


def assess(
    docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The id (and the columns in `keep`) of each row with the base counts, the words on content lines, the lines with a word by
    their mark, and the verdict.
    """
    names = list(dict.fromkeys([id_col, *keep]))
    taken = docs.select(*dict.fromkeys([*names, text_col]))
    kinds = {f.name: f.dataType.simpleString() for f in taken.schema.fields}
    added = {
        "n_words": "long",
        "word_chars": "long",
        "n_symbols": "long",
        "n_dup_lines": "long",
        "n_repeat_words": "long",
        "content_words": "long",
        "content_lines": "long",
        "boilerplate_lines": "long",
        "base_failed": "boolean",
        "kept": "boolean",
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, text_col):
                lines = Lines(common.bytes_of(part, text_col))
                stops = np.searchsorted(lines.line_text, np.arange(lines.n_texts + 1)).tolist()
                content, marked = np.zeros(lines.n_texts, np.int64), np.zeros((2, lines.n_texts), np.int64)
                for k, (a, b) in enumerate(zip(stops, stops[1:])):
                    marks, counts = np.array(field.viterbi(lines.features[a:b]), np.int64), lines.line_words[a:b]
                    content[k] = counts @ marks
                    # Lines without a word carry no share; they are counted with neither.
                    marked[1, k] = np.count_nonzero(marks & (counts > 0))
                    marked[0, k] = np.count_nonzero(counts) - marked[1, k]
                failed = lines.failed()
                kept = ~failed & (content >= CONTENT_SHARE * lines.words)
                numbers = [lines.words, lines.chars, lines.symbols, lines.duplicates, lines.repeated, content]
                numbers += [marked[1], marked[0]]
                columns = [part.column(name) for name in names]
                columns += [pa.array(n, pa.int64()) for n in numbers] + [pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(columns, [*names, *added])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in [*((n, kinds[n]) for n in names), *added.items()])
    return taken.mapInArrow(run, schema)
