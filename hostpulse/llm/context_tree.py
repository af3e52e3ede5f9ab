"""Language-model scores by context-tree weighting over the bytes of words.

A text is coded as its words, each followed by a blank, then one end mark. A byte is coded as eight binary
decisions, each of which has its own context tree over the bytes before it, up to `DEPTH` of them. Contexts reach back to the
start of the word, with blanks before it. Every node holds a Krichevsky-Trofimov estimate of the decisions seen in its context, and
context-tree weighting mixes the estimates of all depths: a node's weighted probability is half its own estimate
and half the product of its children's. The probability of the next decision is then a mixture over the path, whose weights
come from these products. The tree is fixed after training, so what it gives a word does not depend on the word's
place, and each distinct word of the corpus is spelled once.

One longer context reaches across words: the whole word before, a text's beginning counting as the end mark. Its decision is
whether the word follows that training documents have most often there (of equally frequent ones that with the largest hash).
The decision's estimate is mixed with the byte tree below it by the same weighting, over the occurrences after the first,
which names the word; if the decision says no, and in words never seen before, the bytes code the word.

That is `score`. `score_running`, the query's method, codes the running text instead: contexts reach back over blanks into the words before, and
before a text's beginning stand end marks. Every place of the training text counts, so the order of words matters wherever
it falls within `DEPTH` bytes, and no follower is singled out. Tasks are sent the scores of the most frequent grams, up to `SENT_GRAMS`.

Everything is counted over all training documents, in joins and aggregations keyed by context. Tasks are sent the scores of the `COMMON_GRAMS`
contexts and bytes that most distinct words hold, and the `COMMON_WORDS` most frequent words of at most `WORD_BYTES` bytes with theirs; what these don't
cover goes through joins, so scores do not depend on either number.

Null texts count as empty: their only token is the end. Words are lower-cased in A-Z. Repeated rows count as often as they
occur; rows whose `held_out` is null are training rows. Words are told apart by 64-bit hashes where they follow others. Columns besides the id and the text are ignored. Without training
rows every decision is even.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hostpulse.llm import common
from hostpulse.llm.bpe import _Sent

DEPTH = 6
COMMON_GRAMS = 1 << 20
COMMON_WORDS = 200_000
WORD_BYTES = 64
#: A gram, the context and the byte after it, is kept as one 64-bit number.
assert DEPTH <= 7
#: The end of a text as a word of its own; no word holds this byte.
END = b"\n"
#: Distinct words that a task counts before it passes them on, and words whose followers it counts at a time.
HELD_WORDS = 400_000
HELD_PAIRS = 1_000_000
#: Hashes of words that a task remembers.
CACHED_WORDS = 300_000
#: Grams of running text whose scores are sent to tasks, at most.
SENT_GRAMS = 1 << 21
#: Bytes of running text, and distinct grams, that a task handles at a time; shares in which it passes the grams on.
PIECE = 1 << 20
HELD_GRAMS = 3 << 20
SHARES = 1024
#: Bytes of context from which subtrees are worked out whole.
CUT = 3
#: Texts that are numbered by one byte.
GROUP = 256


class _Places(dict):
    """Where a word stands in a list, -1 for words that are not in it."""

    def __missing__(self, word: bytes) -> int:
        return -1


class _Codes(common.WordHashes):
    """Hashes of words as `F.xxhash64` gives them."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return super().of(words).view(np.int64)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each coded byte: `DEPTH` bytes of context and the byte itself as one number, and which word it belongs to."""
    coded = [word if word == END else word + b" " for word in words]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    data = np.frombuffer(b"".join(b" " * DEPTH + word for word in coded), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(coded)), sizes)
    place = np.arange(len(owner)) + DEPTH * (owner + 1)
    number = np.zeros(len(owner), np.int64)
    for k in range(DEPTH + 1):
        number = number << 8 | data[place - DEPTH + k]
    return number, owner


def _counted(docs: DataFrame, text_col: str) -> DataFrame:
    """Each distinct word, the end included, and how often training documents have it; 0 for words of others only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def table() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return made

        for batch in batches:
            for part in common.slices(batch, text_col):
                for text, held in zip(common.bytes_of(part, text_col), part.column("held").to_pylist()):
                    words = words_of(text)
                    if held:
                        counts.update(dict.fromkeys(words, 0))
                        counts[END] += 0
                    else:
                        counts.update(words)
                        counts[END] += 1
                if len(counts) > HELD_WORDS:
                    yield table()
        yield table()

    return docs.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _gram_counts(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, owner = grams(batch.column("word").to_pylist())
            if not len(number):
                continue
            times = batch.column("n").to_numpy()[owner]
            distinct, place = np.unique(number, return_inverse=True)
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, place, times)
            columns = [pa.array(distinct), pa.array(sums), pa.array(np.bincount(place, minlength=len(distinct)))]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "n", "places"])

    made = words.mapInArrow(run, "gram long, n long, places long")
    return made.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("places").alias("places"))


def _log_gamma(x: Column) -> Column:
    """ln(gamma(x)) for x of at least one half: Stirling's series eight places up, less the factors passed."""
    y = x + 8
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y**5)
    factors = x
    for k in range(1, 8):
        factors = factors * (x + k)
    # The product of eight factors overflows for no count below 1e38.
    return series - F.log(factors)


def _log_estimate(zeros: Column, ones: Column) -> Column:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones; it depends on no order."""
    pi = 1.1447298858494002  # ln of pi
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - F.lit(pi)


def _decisions(rows: DataFrame) -> DataFrame:
    """The eight decisions of each gram: `node`, which is the context and the bits already known, and the `bit`."""
    byte = F.col("gram").bitwiseAND(255)
    context = F.shiftrightunsigned("gram", 8)
    step = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.lit(7)),
            lambda k: F.struct(
                # A leading 1 marks how many bits are known.
                (F.shiftleft(context, 8) + F.call_function("shiftright", byte + 256, 8 - k)).alias("node"),
                F.call_function("shiftright", byte, 7 - k).bitwiseAND(1).alias("bit"),
            ),
        )
    )
    return rows.withColumn("d", step).select("gram", "n", "d.node", "d.bit")


def _above(node: Column, depth: int) -> Column:
    """The node of the same decision with the context one byte shorter, from one of this depth."""
    return node.bitwiseAND((1 << (8 * depth)) - 1)


def _estimate() -> Column:
    return _log_estimate(F.col("zeros").cast("double"), F.col("ones").cast("double"))


def _paths(level: DataFrame, depth: int) -> DataFrame:
    """`node`, `p` and `rest` of the nodes of one depth: what the path down to them gives to a 1, and the weight left below.

    `level`, made by `stored` and released: node, zeros, ones and weighted.
    """
    estimate, levels = _estimate(), {depth: level}
    half = F.lit(float(np.log(0.5)))
    for d in range(depth, 0, -1):
        up = levels[d].groupBy(_above(F.col("node"), d).alias("node")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below")
        )
        top = F.greatest("own", "below")
        mixed = half + top + F.log1p(F.exp(F.least("own", "below") - top))
        up = up.withColumn("own", estimate).withColumn("weighted", mixed).drop("own", "below")
        levels[d - 1] = common.stored(up, f"level-{d - 1}")
    # From the root down: what the path has given to a 1 so far, and the weight that is left for deeper nodes.
    paths = None
    for d in range(depth + 1):
        here = levels[d].withColumn("one", (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0))
        stop = F.exp(half + estimate - F.col("weighted")) if d < DEPTH else F.lit(1.0)
        here = here.select("node", "one", F.least(stop, F.lit(1.0)).alias("stop"))
        if paths is None:
            here = here.select("node", (F.col("stop") * F.col("one")).alias("p"), (1 - F.col("stop")).alias("rest"))
            paths = common.stored(here, "path-0")
        else:
            over = paths.select(F.col("node").alias("up"), F.col("p").alias("p0"), F.col("rest").alias("rest0"))
            here = here.withColumn("up", _above(F.col("node"), d)).join(over, "up").select(
                "node",
                (F.col("p0") + F.col("rest0") * F.col("stop") * F.col("one")).alias("p"),
                (F.col("rest0") * (1 - F.col("stop"))).alias("rest"),
            )
            below = common.stored(here, f"path-{d}")
            common.release(paths)
            paths = below
        common.release(levels[d])
    return paths


def gram_scores(counts: DataFrame) -> DataFrame:
    """`gram` and `score`, the log10 probability of its last byte after the others. `counts`: gram, n."""
    steps, depth = _decisions(counts), DEPTH
    level = steps.groupBy("node").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("zeros"),
        F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("ones"),
    )
    paths = _paths(common.stored(level.withColumn("weighted", _estimate()), f"level-{depth}"), depth)
    scored = steps.select("gram", "node", "bit").join(paths.select("node", "p"), "node")
    scored = scored.groupBy("gram").agg(
        F.sum(F.log10(F.when(F.col("bit") == 1, F.col("p")).otherwise(1 - F.col("p")))).alias("score")
    )
    scored = common.stored(scored, "gram-scores")
    common.release(paths)
    return scored


def word_scores(words: DataFrame, counts: DataFrame, scores: DataFrame, common_grams: int = COMMON_GRAMS) -> DataFrame:
    """`word`, `n` and `score`, the log10 probability of the word: the sum over its bytes."""
    spark = words.sparkSession
    both = common.stored(counts.join(scores, "gram"), "grams")
    frequent = both.orderBy(F.desc("places"), "gram").limit(common_grams).select("gram", "score").toArrow()
    order = np.argsort(frequent.column("gram").to_numpy())
    sent = _Sent(spark, (frequent.column("gram").to_numpy()[order], frequent.column("score").to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, values = sent.value
        for batch in batches:
            number, owner = grams(batch.column("word").to_pylist())
            place = np.minimum(np.searchsorted(known, number), max(0, len(known) - 1))
            hit = known[place] == number if len(known) else np.zeros(len(number), bool)
            sums = np.bincount(owner[hit], values[place[hit]], batch.num_rows) if hit.any() else np.zeros(batch.num_rows)
            misses = np.bincount(owner[~hit], minlength=batch.num_rows)
            stops = np.cumsum(np.r_[0, misses]).astype(np.int32)
            rest = pa.ListArray.from_arrays(stops, pa.array(number[~hit]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums), rest], ["word", "n", "part", "rest"])

    parts = common.stored(words.mapInArrow(run, "word binary, n long, part double, rest array<long>"), "word-parts")
    # Grams outside the frequent ones are rare, so no value of this join is hot.
    rare = (
        parts.where(F.size("rest") > 0)
        .select("word", F.explode("rest").alias("gram"))
        .join(both.select("gram", "score"), "gram")
        .groupBy("word")
        .agg(F.sum("score").alias("more"))
    )
    joined = parts.where(F.size("rest") > 0).select("word", "n", "part").join(rare, "word")
    done = parts.where(F.size("rest") == 0).select("word", "n", F.col("part").alias("score"))
    done = done.union(joined.select("word", "n", (F.col("part") + F.col("more")).alias("score")))
    done = common.stored(done, "word-scores")
    common.release(both, parts)
    return done


def _pairs(docs: DataFrame, text_col: str) -> DataFrame:
    """Hashes of each word `prev`, that of the end before a text's first, and its follower `next`, with their number `n`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes(CACHED_WORDS)
        end = codes.of([END])
        held: list[np.ndarray] = []

        def table() -> pa.RecordBatch:
            following = np.concatenate([end[:0], *held])
            before = np.r_[end, following][:-1]
            both = common.mixed(before) + following.view(np.uint64)
            _, place, n = np.unique(both, return_index=True, return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(before[place]), pa.array(following[place]), pa.array(n)], ["prev", "next", "n"]
            )

        for batch in batches:
            for part in common.slices(batch, text_col):
                words: list[bytes] = []
                for text in common.bytes_of(part, text_col):
                    words += words_of(text)
                    words.append(END)
                held.append(codes.of(words))
                if sum(map(len, held)) > HELD_PAIRS:
                    yield table()
        yield table()

    made = docs.mapInArrow(run, "prev long, next long, n long")
    return made.groupBy("prev", "next").agg(F.sum("n").alias("n"))


def followers(pairs: DataFrame, scored: DataFrame, common_words: int = COMMON_WORDS) -> DataFrame:
    """For each word of training documents, `prev`: `next`, its most frequent follower, and what the context of the
    whole word adds to the log10 probability of the bytes if that follows (`gain`) and if another does (`loss`).

    `scored`: code (the word's hash), n and score.
    """
    best = pairs.groupBy("prev").agg(F.sum("n").alias("total"), F.max(F.struct("n", "next")).alias("best"))
    best = common.stored(best.select("prev", "total", "best.n", "best.next"), "best-followers")
    # A frequent word may follow many, a rare one only as many as its occurrences.
    scores = scored.select(F.col("code").alias("next"), "score")
    frequent = scored.orderBy(F.desc("n"), "code").limit(common_words).select(F.col("code").alias("next"), "score")
    frequent = common.stored(frequent, "frequent-followers")
    known = best.join(F.broadcast(frequent), "next")
    rest = best.join(F.broadcast(frequent.select("next")), "next", "left_anti").join(scores, "next")
    hits = (F.col("n") - 1).cast("double")
    misses = (F.col("total") - F.col("n")).cast("double")
    ten = float(np.log(10.0))
    ratio = F.greatest(_log_estimate(misses, hits) - hits * F.col("score") * ten, F.lit(-600.0))
    share = (hits + 0.5) / (hits + misses + 1.0) / (1 + F.exp(-ratio))
    rows = known.unionByName(rest).withColumn("p", share)
    bytes_too = F.log1p((1 - F.col("p")) * F.exp(F.col("score") * ten) / F.col("p")) / ten
    gain = F.log10("p") - F.col("score") + bytes_too
    return rows.select("prev", "next", gain.alias("gain"), (F.log1p(-F.col("p")) / ten).alias("loss"))


def score(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    common_words: int = COMMON_WORDS,
    common_grams: int = COMMON_GRAMS,
) -> DataFrame:
    """Scores of all rows by a model of those that are not `held_out`.

    Columns: id, held_out, n_tokens, n_known, train_tokens, base_score (of single words with 0.1 added to each count), score,
    n_coded (bytes coded) and bits_per_byte (the code length).
    """
    spark = docs.sparkSession
    rows = docs.select(
        *common.row_key(id_col, text_col),
        F.col(id_col).alias("id"),
        held_out.alias("held"),
        F.col(text_col).alias("text"),
    )
    words = common.stored(_counted(rows.select("text", "held"), "text"), "words")
    counts = common.stored(_gram_counts(words), "gram-counts")
    bytewise = gram_scores(counts)
    listed = word_scores(words, counts, bytewise, common_grams)
    common.release(words, counts, bytewise)
    spelled = listed.withColumn("code", F.xxhash64("word"))
    training = rows.where(~F.coalesce("held", F.lit(False))).select("text")
    follow = followers(_pairs(training, "text"), spelled, common_words)
    none = {"next": 0, "gain": 0.0, "loss": 0.0}
    scored = spelled.join(follow.withColumnRenamed("prev", "code"), "code", "left").fillna(none)
    scored = common.stored(scored, "followers")
    common.release(listed)
    totals = scored.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    train, distinct = totals.n or 0, totals.v or 0
    norm = float(np.log10(train + 0.1 * (distinct + 1)))
    table = (
        scored.where((F.length("word") <= WORD_BYTES) | (F.col("word") == F.lit(END)))
        .orderBy(F.desc(F.col("word") == F.lit(END)), F.desc("n"), "word")
        .limit(common_words)
        .toArrow()
    )
    columns = (table.column(c).to_numpy() for c in ("n", "score", "code", "next", "gain", "loss"))
    sent = _Sent(spark, (table.column("word").to_pylist(), *columns))
    names = ["id", "held", "n_tokens", "n_known", "base", "score", "n_coded", "rare", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, n, scores, codes, follower, gains, losses = sent.value
        others = _Codes(CACHED_WORDS)
        place = _Places(zip(listed, range(len(listed))))
        bases = np.log10(n + 0.1) - norm
        for batch in batches:
            for part in common.slices(batch, "text"):
                words, ends = [], [0]
                for text in common.bytes_of(part, "text"):
                    words += words_of(text)
                    words.append(END)
                    ends.append(len(words))
                sizes = np.diff(ends)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                found = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                hit = found >= 0
                whose, which = owner[hit], found[hit]
                sums = [np.bincount(whose, v[which], len(sizes)) for v in (n > 0, bases, scores)]
                missed = np.flatnonzero(~hit).tolist()
                rare = [words[k] for k in missed]
                code = np.empty(len(words), np.int64)
                code[hit], code[~hit] = codes[which], others.of(rare)
                # The end is the first of the list, and stands before every text's first word.
                before = np.r_[0, found][:-1]
                at = np.flatnonzero(before >= 0)
                before = before[at]
                sums[2] += np.bincount(
                    owner[at], np.where(code[at] == follower[before], gains[before], losses[before]), len(sizes)
                )
                letters = np.fromiter(map(len, words), np.int64, len(words))
                coded = np.bincount(owner, letters, len(sizes)).astype(np.int64) + sizes - 1
                stops = np.cumsum(np.r_[0, np.bincount(owner[~hit], minlength=len(sizes))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("held"),
                        pa.array(sizes, pa.int64()),
                        pa.array(sums[0].astype(np.int64)),
                        *map(pa.array, sums[1:]),
                        pa.array(coded),
                        pa.ListArray.from_arrays(pa.array(stops), pa.array(rare, pa.binary())),
                        pa.ListArray.from_arrays(pa.array(stops), pa.array(code[np.asarray(missed, np.int64) + 1])),
                    ],
                    names,
                )

    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, held boolean, n_tokens long, n_known long, base double, score double, n_coded long, "
        "rare array<binary>, after array<long>"
    )
    # The row numbers tie the rare words to their rows; they are fixed by being written.
    found = rows.select("id", "held", "text").mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    found = common.stored(found, "scores")
    rest = (
        found.select("row", F.explode(F.arrays_zip("rare", "after")).alias("w"))
        .select("row", F.col("w.rare").alias("word"), F.col("w.after").alias("after"))
        .join(scored.withColumnRenamed("score", "s"), "word")
        .groupBy("row")
        .agg(
            F.sum((F.col("n") > 0).cast("long")).alias("more_known"),
            F.sum(F.log10(F.col("n") + 0.1) - norm).alias("more_base"),
            F.sum(F.col("s") + F.when(F.col("after") == F.col("next"), F.col("gain")).otherwise(F.col("loss"))).alias("more_score"),
        )
    )
    whole = found.drop("rare", "after").join(rest, "row", "left")
    final = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return whole.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        final.alias("score"),
        "n_coded",
        (-final / F.log10(F.lit(2.0)) / F.col("n_coded")).alias("bits_per_byte"),
    )


def running_grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As `grams`, for the running text of at most `GROUP` texts of words and ends: each number and which text it belongs to."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + DEPTH
    data = np.frombuffer(b"".join(DEPTH * END + text for text in texts), np.uint8)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint8), sizes)
    coded = np.ones(len(data), bool)
    coded[((np.cumsum(sizes) - sizes)[:, None] + np.arange(DEPTH)).ravel()] = False
    for low in range(DEPTH, len(data), PIECE):
        high = min(len(data), low + PIECE)
        number = np.zeros(high - low, np.int64)
        for k in range(DEPTH + 1):
            number <<= 8
            number |= data[low - DEPTH + k : high - DEPTH + k]
        mine = coded[low:high]
        yield number[mine], owner[low:high][mine]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[starts], np.add.reduceat(count, starts) if len(key) else count


def _running_counts(rows: DataFrame) -> DataFrame:
    """Each gram of the running text: `n`, how often training documents have it, and `places`, how often all have it.

    Tasks add up what they have and pass it on in `SHARES` shares by the gram's hash, a row for each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0

        def table() -> pa.RecordBatch:
            key, count = _added(keys, counts)
            share = (common.mixed(key >> 1) % np.uint64(SHARES)).astype(np.int64)
            order = np.argsort(share, kind="stable")
            stops = np.cumsum(np.bincount(share, minlength=SHARES))[:-1]
            parts = [[x.tobytes() for x in np.split(values[order], stops)] for values in (key, count)]
            some = [k for k in range(SHARES) if parts[0][k]]
            columns = [pa.array(some, pa.int32()), *(pa.array([part[k] for k in some], pa.binary()) for part in parts)]
            return pa.RecordBatch.from_arrays(columns, ["share", "keys", "counts"])

        for batch in batches:
            for part in common.slices(batch, "text", PIECE):
                aside = part.column("held").to_pylist()
                texts = [b" ".join([*words_of(text), END]) for text in common.bytes_of(part)]
                for start in range(0, len(texts), GROUP):
                    flags = np.array([bool(x) for x in aside[start : start + GROUP]], np.int64)
                    for number, owner in running_grams(texts[start : start + GROUP]):
                        key, n = np.unique(number << 1 | flags[owner], return_counts=True)
                        keys.append(key), counts.append(n)
                        held += len(key)
                        if held > HELD_GRAMS:
                            key, n = _added(keys, counts)
                            keys[:], counts[:], held = [key], [n], len(key)
                            if 5 * held > 4 * HELD_GRAMS:
                                yield table()
                                keys[:], counts[:], held = [key[:0]], [n[:0]], 0
        yield table()
        keys.clear(), counts.clear()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, most = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, HELD_GRAMS
        for batch in batches:
            for key, n in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                keys.append(np.frombuffer(key, np.int64)), counts.append(np.frombuffer(n, np.int64))
                held += len(keys[-1])
                if held > most:
                    key, n = _added(keys, counts)
                    keys[:], counts[:], held = [key], [n], len(key)
                    most = max(HELD_GRAMS, 2 * held)
        key, n = _added(keys, counts)
        keys.clear(), counts.clear()
        gram, places = _added([key >> 1], [n])
        _, training = _added([key >> 1], [np.where(key & 1, 0, n)])
        for start in range(0, len(gram), HELD_WORDS):
            own = slice(start, start + HELD_WORDS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[own]), pa.array(training[own]), pa.array(places[own])], ["gram", "n", "places"]
            )
        del key, n, gram, places, training

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = rows.mapInArrow(count, "share int, keys binary, counts binary").repartition(parts, "share")
    return shares.mapInArrow(add, "gram long, n long, places long")


def _log_gammas(x: np.ndarray) -> np.ndarray:
    """As `_log_gamma`."""
    y, factors = x + 8, x.copy()
    for k in range(1, 8):
        factors *= x + k
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(factors)


class _Subtrees:
    """The nodes from `CUT` bytes of context down, of grams that hold all that end in the same `CUT` bytes of context."""

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        steps = np.arange(8)[:, None]
        byte = gram & 255
        self.bits = (byte >> (7 - steps)) & 1
        node = (gram >> 8 << 8) | ((byte + 256) >> (8 - steps))
        self.nodes, at = np.unique(node.ravel(), return_inverse=True)
        self.leaves = at.reshape(node.shape)
        ones = np.bincount(at.ravel(), (self.bits * n).ravel(), len(self.nodes))
        zeros = np.bincount(at.ravel(), ((1 - self.bits) * n).ravel(), len(self.nodes))
        #: From the deepest up: the estimate of a 1, the share that stops here, and the place in the next level.
        self.levels: list[tuple] = []
        half, weighted = np.log(0.5), None
        for depth in range(DEPTH, CUT - 1, -1):
            own = _log_gammas(zeros + 0.5) + _log_gammas(ones + 0.5) - _log_gammas(zeros + ones + 1) - np.log(np.pi)
            weighted = own if weighted is None else half + np.logaddexp(own, weighted)
            stop = np.ones(len(own)) if depth == DEPTH else np.minimum(1, np.exp(half + own - weighted))
            if depth == CUT:
                self.zeros, self.ones, self.weighted = zeros, ones, weighted
                break
            one = (ones + 0.5) / (zeros + ones + 1)
            self.nodes, up = np.unique(self.nodes & ((1 << (8 * depth)) - 1), return_inverse=True)
            self.levels.append((one, stop, up))
            zeros, ones, weighted = (np.bincount(up, x, len(self.nodes)) for x in (zeros, ones, weighted))

    def scores(self, p: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Of each gram, by `p` and `rest` of `nodes`."""
        for one, stop, up in reversed(self.levels):
            p, rest = p[up] + rest[up] * stop * one, rest[up] * (1 - stop)
        p = p[self.leaves]
        return np.log10(np.where(self.bits == 1, p, 1 - p)).sum(axis=0)


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of about `PIECE` / 32 rows or more at a time, in the order of `suffix`, that divide none."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        held.append({name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names})
        if sum(len(part["suffix"]) for part in held) >= PIECE // 32:
            rows = {name: np.concatenate([part[name] for part in held]) for name in held[0]}
            end = int(np.searchsorted(rows["suffix"], rows["suffix"][-1]))
            if end:
                yield {name: values[:end] for name, values in rows.items()}
            held = [{name: values[end:] for name, values in rows.items()}]
    if held and sum(len(part["suffix"]) for part in held):
        yield {name: np.concatenate([part[name] for part in held]) for name in held[0]}


def running_scores(counts: DataFrame) -> DataFrame:
    """`gram`, `places` and `score`, as by `gram_scores`, of `counts`: gram, n, places.

    Nodes of at least `CUT` bytes of context are worked out in arrays, for all grams at once whose contexts end in the same
    `CUT` bytes; those above are few, and joined.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    suffix = F.shiftrightunsigned("gram", 8).bitwiseAND((1 << (8 * CUT)) - 1).alias("suffix")

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _subtree_rows(batches):
            tree = _Subtrees(rows["gram"], rows["n"])
            columns = (tree.nodes, tree.zeros.astype(np.int64), tree.ones.astype(np.int64), tree.weighted)
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["node", "zeros", "ones", "weighted"])
            del rows, tree, columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _subtree_rows(batches):
            below = rows["known"] == 0
            gram, node = rows["gram"][below], rows["gram"][~below]
            tree = _Subtrees(gram, rows["n"][below])
            order = np.argsort(node)
            order = order[np.searchsorted(node[order], tree.nodes)]
            columns = gram, rows["places"][below], tree.scores(rows["p"][~below][order], rows["rest"][~below][order])
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["gram", "places", "score"])
            del rows, tree, columns

    own = counts.select(suffix, "gram", "n").repartition(parts, "suffix").sortWithinPartitions("suffix")
    level = own.mapInArrow(top, "node long, zeros long, ones long, weighted double")
    paths = _paths(common.stored(level, f"level-{CUT}"), CUT)
    none, zero = F.lit(0).cast("long"), F.lit(0.0)
    grams_too = counts.select(suffix, F.lit(0).alias("known"), "gram", "n", "places", zero.alias("p"), zero.alias("rest"))
    above = paths.select(
        F.shiftrightunsigned("node", 8).alias("suffix"),
        F.lit(1).alias("known"),
        F.col("node").alias("gram"),
        none.alias("n"),
        none.alias("places"),
        "p",
        "rest",
    )
    both = grams_too.unionByName(above).repartition(parts, "suffix").sortWithinPartitions("suffix")
    scored = common.stored(both.mapInArrow(score, "gram long, places long, score double"), "grams")
    common.release(paths)
    return scored


def _frequent(grams: DataFrame, most: int) -> DataFrame:
    """The grams of most places, at most so many of them; those of about equally many places go together."""
    class_of = F.floor(16 * F.log2("places"))
    sizes = {r["class"]: r["count"] for r in grams.groupBy(class_of.alias("class")).count().collect()}
    lowest, total = max(sizes, default=0) + 1, 0
    for number in sorted(sizes, reverse=True):
        total += sizes[number]
        if total > most:
            break
        lowest = number
    return grams.where(class_of >= lowest)


def score_running(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    common_words: int = COMMON_WORDS,
    sent_grams: int = SENT_GRAMS,
) -> DataFrame:
    """As `score`, with the same columns, by contexts of the running text."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), held_out.alias("held"), F.col(text_col).alias("text"))
    listed = common.stored(_counted(rows.select("text", "held"), "text"), "words")
    counts = common.stored(_running_counts(rows.select("text", "held")), "gram-counts")
    both = running_scores(counts)
    common.release(counts)
    frequent = _frequent(both, sent_grams).select("gram", "score").toArrow()
    order = np.argsort(frequent.column("gram").to_numpy())
    sent = _Sent(spark, (frequent.column("gram").to_numpy()[order], frequent.column("score").to_numpy()[order]))
    del frequent, order
    totals = listed.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    train, distinct = totals.n or 0, totals.v or 0
    norm = float(np.log10(train + 0.1 * (distinct + 1)))
    table = listed.where(F.length("word") <= WORD_BYTES).orderBy(F.desc("n"), "word").limit(common_words).toArrow()
    known_words = _Sent(spark, (table.column("word").to_pylist(), table.column("n").to_numpy()))
    names = ["id", "held", "n_tokens", "n_known", "base", "score", "n_coded", "words", "grams", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, values = sent.value
        spelled, n = known_words.value
        place = _Places(zip(spelled, range(len(spelled))))
        bases = np.log10(n + 0.1) - norm

        def lists(owner: np.ndarray, rows: int) -> pa.Array:
            return pa.array(np.cumsum(np.r_[0, np.bincount(owner, minlength=rows)]).astype(np.int32))

        for batch in batches:
            for part in common.slices(batch, "text", PIECE):
                own = [[*words_of(text), END] for text in common.bytes_of(part)]
                texts = [b" ".join(words) for words in own]
                sizes = np.fromiter(map(len, own), np.int64, len(own))
                words = [word for some in own for word in some]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                found = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                hit = found >= 0
                sums = [np.bincount(owner[hit], v[found[hit]], len(sizes)) for v in (n > 0, bases)]
                rare = [words[k] for k in np.flatnonzero(~hit).tolist()]
                total = np.zeros(len(sizes))
                missed = [np.zeros((3, 0), np.int64)]
                for start in range(0, len(texts), GROUP):
                    for number, which in running_grams(texts[start : start + GROUP]):
                        # Sorted, so that the search goes through the table in order.
                        key, times = np.unique(number.view(np.uint64) << np.uint64(8) | which, return_counts=True)
                        gram, whose = (key >> np.uint64(8)).view(np.int64), start + (key & np.uint64(255)).view(np.int64)
                        at = np.minimum(np.searchsorted(known, gram), max(0, len(known) - 1))
                        there = known[at] == gram if len(known) else np.zeros(len(gram), bool)
                        if there.any():
                            total += np.bincount(whose[there], values[at[there]] * times[there], len(sizes))
                        missed.append(np.stack([whose[~there], gram[~there], times[~there]]))
                others = np.concatenate(missed, axis=1)
                others = others[:, np.argsort(others[0], kind="stable")]
                stops = lists(others[0], len(sizes))
                columns = [pa.array(sizes), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(total)]
                columns += [
                    pa.array(np.fromiter(map(len, texts), np.int64, len(texts))),
                    pa.ListArray.from_arrays(lists(owner[~hit], len(sizes)), pa.array(rare, pa.binary())),
                    *(pa.ListArray.from_arrays(stops, pa.array(values)) for values in others[1:]),
                ]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held"), *columns], names)

    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, held boolean, n_tokens long, n_known long, base double, score double, n_coded long, "
        "words array<binary>, grams array<long>, times array<long>"
    )
    # The row numbers tie the rare words and grams to their rows; they are fixed by being written.
    found = common.stored(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scores")
    words = (
        found.select("row", F.explode("words").alias("word"))
        .join(listed, "word")
        .groupBy("row")
        .agg(
            F.sum((F.col("n") > 0).cast("long")).alias("more_known"),
            F.sum(F.log10(F.col("n") + 0.1) - norm).alias("more_base"),
        )
    )
    grams_left = (
        found.select("row", F.explode(F.arrays_zip("grams", "times")).alias("g"))
        .select("row", F.col("g.grams").alias("gram"), F.col("g.times").alias("times"))
        .join(both.withColumnRenamed("score", "s"), "gram")
        .groupBy("row")
        .agg(F.sum(F.col("s") * F.col("times")).alias("more_score"))
    )
    whole = found.drop("words", "grams", "times").join(words, "row", "left").join(grams_left, "row", "left")
    final = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return whole.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(train).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        final.alias("score"),
        "n_coded",
        (-final / F.log10(F.lit(2.0)) / F.col("n_coded")).alias("bits_per_byte"),
    )
