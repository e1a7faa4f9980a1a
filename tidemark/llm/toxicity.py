"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel compares words by their common subsequences of three symbols (letters, and the borders of words), each
occurrence weighted down with the stretch it covers, so letters between those of an insult cost little. Words are
told apart by landmarks: kernel values against them, whitened, are the inputs of a linear SVM. As the kernel is an
inner product over subsequences, the trained expansion over landmarks adds up to one weight for each subsequence,
which makes scoring exact and linear in the text. A sentence is as toxic as its worst word, and a document's score is
a logistic function of its sentences' margins.

Training takes labelled documents as bags of sentences. Runs of letters that stand in toxic documents far beyond
chance say where to look: words with such a run are positive if they stand mostly in toxic documents; those that
stand mostly in clean ones, and all other words of clean documents, are negative. The machine is fitted on a working
set, which takes in clean words beyond the margin round by round until none is left outside. The logistic function has
no negative weight, so more evidence never lowers a score; it is fitted on the margins that each half of the documents
gets from a machine fitted on the words of the other half.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import fold_of, sampled
from .letters import TABLE, code_points
from .shared import give_back, staged, steps

#: Labelled documents of each class that a model is fitted on, about; the only bound on what is read to fit.
SAMPLE_DOCUMENTS = 2500
LANDMARKS = 400
#: Clean words that one round takes into the working set; rounds go on until no word outside it is beyond the margin.
ROUND_WORDS, MARGIN = 1500, -0.9
#: Symbols of the runs whose documents are counted to find what marks toxic ones; how unlikely by chance, as a natural
#: logarithm beyond that of the number of runs, a run's documents must be; and how many times the usual share of them
#: must be toxic. A word with such a run is positive if this share of its own documents is toxic, else negative.
RUN_SYMBOLS, SURPRISE, LIFT, WORD_SHARE = (4, 5, 6), 3.0, 3.0, 0.5
#: Weight of a subsequence for each symbol of the stretch it covers, and the longest stretch less one.
DECAY, STRETCH = 0.6, 5
#: Symbols of the pieces that a longer word is also scored by; pieces overlap by half.
PIECE = 24
#: Text bytes of a numpy step; some twenty numbers are held for each.
STEP = 1 << 18
SYMBOLS = 32
# fixed values: characters that stand for letters
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

GAPS = [(a, b) for a in range(1, STRETCH) for b in range(1, STRETCH - a + 1)]


@cache
def symbols() -> np.ndarray:
    """A symbol for each code point: 1-26 for plain Latin letters, 27-31 for other letters, 0 for no letter, 255 for blanks."""
    out = np.zeros(TABLE + 1, np.uint8)
    for c in range(TABLE):
        x = chr(c)
        if x.isspace():
            out[c] = 255
        elif x in LOOKALIKE:
            out[c] = ord(LOOKALIKE[x]) - 96
        elif unicodedata.category(x)[0] == "L":
            small = x.lower()[0]
            out[c] = ord(small) - 96 if "a" <= small <= "z" else 27 + ord(small) % 5
    out[TABLE] = 31
    return out


def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words end to end, where each word starts, and its row.

    Words are what blanks separate, less the characters that are no letters, with the border symbol 0 on both sides;
    letters that stand alone one after another are one word. Look-alike digits count as letters only in words that hold
    a letter. Words with other characters inside also count by their stretches of letters, and long words by pieces.
    """
    points, bounds = code_points(column)
    found = symbols()[np.minimum(points, TABLE)]
    n = len(column)
    rows = np.repeat(np.arange(n), np.diff(bounds))
    blank = found == 255
    fresh = np.concatenate(([True], blank[:-1] | (rows[1:] != rows[:-1])))[: len(found)]
    word = np.cumsum(fresh) - 1
    solid = ~blank & (found > 0)
    is_letter = solid & (points >= 65)
    letters_in = np.bincount(word[is_letter], minlength=int(word[-1]) + 1 if len(word) else 0)
    solid &= letters_in[word] > 0 if len(word) else solid
    place = np.flatnonzero(solid)
    code, word, rows = found[place], word[place], rows[place]
    starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))[: len(word)])
    row = rows[starts]
    single = np.diff(np.append(starts, len(code))) == 1
    glued = single[1:] & single[:-1] & (row[1:] == row[:-1])
    starts = starts[np.concatenate(([True], ~glued))[: len(starts)]]
    ends = np.append(starts[1:], len(code))[: len(starts)]
    # stretches of letters of words that other characters cut
    cut = np.flatnonzero(np.concatenate(([True], (np.diff(place) != 1) | (word[1:] != word[:-1])))[: len(place)])
    stop = np.append(cut[1:], len(code))[: len(cut)]
    owner = np.searchsorted(starts, cut, "right") - 1
    inner = (stop - cut >= 3) & ((cut != starts[owner]) | (stop != ends[owner])) if len(cut) else np.zeros(0, bool)
    low, high = np.concatenate((starts, cut[inner])), np.concatenate((ends, stop[inner]))
    closed = np.ones(len(low), bool)
    long = np.flatnonzero(high - low > PIECE)
    if len(long):
        k = -(-(high[long] - low[long]) // (PIECE // 2)) - 1
        begin = np.repeat(low[long], k) + (np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)) * (PIECE // 2)
        low, high = np.concatenate((low, begin)), np.concatenate((high, np.minimum(begin + PIECE, np.repeat(high[long], k))))
        closed = np.concatenate((closed, np.zeros(len(begin), bool)))
    size = high - low
    at = np.cumsum(size + 2) - size - 2
    out = np.zeros(int((size + 2).sum()), np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[inside + np.repeat(at + 1, size)] = code[inside + np.repeat(low, size)]
    if not closed.all():  # pieces have no borders: they repeat their first and last letter
        out[at[~closed]], out[(at + size + 1)[~closed]] = code[low[~closed]], code[high[~closed] - 1]
    return out, at, rows[low]


def _norms(longest: int) -> np.ndarray:
    size = np.arange(longest + 1)
    total = sum(np.maximum(size - a - b, 0) * DECAY ** (2 * (a + b + 1)) for a, b in GAPS)
    return np.sqrt(np.maximum(total, DECAY**6))


def margins(code: np.ndarray, starts: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's value of every word."""
    if not len(starts):
        return np.zeros(0)
    ends = np.append(starts[1:], len(code))
    room = np.repeat(ends, ends - starts) - np.arange(len(code))
    wide = code.astype(np.int32)
    total = np.zeros(len(code))
    for a, b in GAPS:
        n = len(code) - a - b
        if n > 0:
            at = (wide[:n] * SYMBOLS + wide[a : a + n]) * SYMBOLS + wide[a + b :]
            total[:n] += np.where(room[:n] > a + b, weights[at], 0.0) * DECAY ** (a + b + 1)
    size = ends - starts
    return np.add.reduceat(total, starts) / _norms(int(size.max()))[size] + bias


def packed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of words given as symbol strings, end to end, and where each starts."""
    code = np.frombuffer("".join(words).encode("latin-1"), np.uint8) - 64
    return code, np.cumsum([0, *map(len, words)])[:-1].astype(np.int64)


def feature(word: str) -> np.ndarray:
    """The kernel's explicit vector of a word, divided by the norm of its length."""
    c = np.frombuffer(word.encode("latin-1"), np.uint8).astype(np.int64) - 64
    out = np.zeros(SYMBOLS**3)
    for a, b in GAPS:
        n = len(c) - a - b
        if n > 0:
            np.add.at(out, (c[:n] * SYMBOLS + c[a : a + n]) * SYMBOLS + c[a + b :], DECAY ** (a + b + 1))
    return out / _norms(len(c))[len(c)]


def svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 25, seed: int = 3) -> np.ndarray:
    """A linear machine with squared hinge loss by dual coordinate descent; the last input is constant."""
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(y))
    square = np.concatenate([(x[k : k + 1024] ** 2).sum(1) for k in range(0, len(x), 1024)]) + 1 / (2 * cost)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        most = 0.0
        for k in rng.permutation(len(y)):
            gradient = y[k] * (w @ x[k]) - 1 + alpha[k] / (2 * cost[k])
            new = max(alpha[k] - gradient / square[k], 0.0)
            if new != alpha[k]:
                most = max(most, abs(new - alpha[k]))
                w += (new - alpha[k]) * y[k] * x[k]
                alpha[k] = new
        if most < 1e-3:
            break
    return w


def _variants(words: list[str], rng: np.random.Generator) -> list[str]:
    """Each word with one symbol put in and each with one doubled, as insults are disguised; borders stay outside."""
    out = []
    for w in words:
        if len(w) > 5:
            at = int(rng.integers(2, len(w) - 1))
            out += [w[:at] + chr(64 + int(rng.integers(1, 27))) + w[at:], w[:at] + w[at - 1] + w[at:]]
    return out


@dataclass
class Machine:
    """Weights of subsequences and the logistic over a document's margins."""

    weights: np.ndarray
    bias: float = -1.0
    logistic: tuple[float, ...] = (-3.0, 4.0, 1.0, 1.0, 1.0)

    def document(self, column: pa.Array) -> np.ndarray:
        """For every row: the largest margin, and logarithms of the sum of those over 0 and of how many words are over 0
        and well over it. A further word can only raise them."""
        code, starts, row = units(column)
        value = margins(code, starts, self.weights, self.bias)
        n = len(column)
        top = np.full(n, -2.0)
        np.maximum.at(top, row, value)
        total = np.log1p(np.bincount(row, np.maximum(value, 0), n))
        return np.stack([np.clip(top, -2, 4), total, *(np.log1p(np.bincount(row[value > least], minlength=n)) for least in (0.0, 0.5))], 1)

    def score(self, column: pa.Array) -> np.ndarray:
        x = self.document(column)
        b, *w = self.logistic
        return 1 / (1 + np.exp(-np.clip(b + x @ np.array(w), -30, 30)))


def fit_words(positive: list[str], negative: list[str], landmarks: int = LANDMARKS, seed: int = 11) -> Machine:
    """Landmarks spread over both classes, Nyström inputs, an SVM, and its weights for each subsequence."""
    rng = np.random.default_rng(seed)
    good, bad = positive + _variants(positive, rng), negative
    words = good + bad
    code, starts = packed(words)
    y = np.concatenate((np.ones(len(good)), -np.ones(len(bad))))
    groups = [(np.arange(len(positive)), min(landmarks // 2, len(positive))), (np.arange(len(good), len(words)), min(landmarks // 2, len(bad)))]
    total = sum(n for _, n in groups)
    chosen, marks, kernel = [], np.zeros((total, SYMBOLS**3), np.float32), np.zeros((len(words), total))
    for group, n in groups:
        near = np.full(len(words), np.inf)
        near[group] = -1.0
        for _ in range(n):  # farthest first
            k, at = int(np.argmin(near)), len(chosen)
            chosen.append(k)
            marks[at] = feature(words[k])
            kernel[:, at] = margins(code, starts, marks[at], 0.0)
            near[group] = np.maximum(near[group], kernel[group, at])
    value, vector = np.linalg.eigh((kernel[chosen] + kernel[chosen].T) / 2)
    kept = value > 1e-6 * value.max()
    whiten = vector[:, kept] / np.sqrt(value[kept])
    inputs = kernel @ whiten
    del kernel  # of these tables, each of all words by all landmarks, the driver holds two at most
    z = np.ones((len(words), inputs.shape[1] + 1))
    z[:, :-1] = inputs
    del inputs
    cost = np.where(y > 0, 4.0 * max(1.0, len(bad) / max(1, len(good))), 4.0)
    w = svm(z, y, cost)
    return Machine(marks.T @ (whiten @ w[:-1]).astype(np.float32), float(w[-1]))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights by Newton's method with a small penalty, none of the inputs' below 0: inputs that ask for less are left out.

    Both classes weigh the same, so a score of 0.5 is where a text fits one as well as the other.
    """
    each = np.where(y > 0, len(y) / (2 * max(1.0, y.sum())), len(y) / (2 * max(1.0, len(y) - y.sum())))
    free = list(range(x.shape[1]))
    while True:
        own = np.hstack([np.ones((len(x), 1)), x[:, free]])
        w = np.zeros(own.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            step = np.linalg.solve((own * (each * p * (1 - p))[:, None]).T @ own + 0.05 * np.eye(len(w)), own.T @ (each * (p - y)) + 0.05 * w)
            w -= np.clip(step, -2, 2)
            if abs(step).max() < 1e-6:
                break
        if not free or w[1:].min() >= 0:
            break
        free.pop(int(w[1:].argmin()))
    out = np.zeros(x.shape[1] + 1)
    out[[0, *(k + 1 for k in free)]] = w
    return tuple(float(v) for v in out)


def _labelled(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, most: int) -> DataFrame:
    """text, toxic, weight and half (0 or 1) of about ``most`` labelled documents of each class, each text once.

    A text with both labels is toxic. Near copies, which mostly share the two least hashes of their long words, have
    weight 1 together, as chance words of one text would else look typical, and are of one half.
    """
    known = labels.where(F.col(label).isin(0, 1) & (fold_of(F.col(key)) != 0)).groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    chosen = sampled(known, "toxic", key, most)
    # the sample's keys, of which there are about twice ``most``
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null").join(F.broadcast(chosen.withColumnRenamed(key, "key")), "key")
    rows = rows.groupBy("text").agg(F.max("toxic").alias("toxic"))
    long = F.transform(F.filter(F.split("text", " "), lambda w: F.length(w) >= 8), lambda w: F.xxhash64(w))
    least = F.when(F.size(long) > 1, F.slice(F.array_sort(F.array_distinct(long)), 1, 2)).otherwise(F.array(F.xxhash64("text")))
    rows = staged(rows.withColumn("least", least), "labelled")
    sizes = rows.groupBy("least", "toxic").agg((1 / F.count("*")).alias("weight"))
    half = F.pmod(F.xxhash64("least"), F.lit(2)).cast("int").alias("half")
    return staged(rows.join(sizes, ["least", "toxic"]).select("text", "toxic", "weight", half), "weighted")


def _counted(rows: DataFrame, scan, found: str, *more: str) -> DataFrame:
    """word, t and c: weights of the toxic and of the clean documents with it; and ``more`` sums."""
    parts = rows.mapInArrow(scan, ", ".join([f"word {found}", *(f"{c} double" for c in ("t", "c", *more))]))
    return parts.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("t", "c", *more)))


def _run_counts(rows: DataFrame) -> DataFrame:
    """The weights of documents with each run of RUN_SYMBOLS symbols; a run is its symbols in base 32 behind a one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            code, starts, row = units(batch.column("text"))
            toxic, weight = batch.column("toxic").to_numpy().astype(bool), batch.column("weight").to_numpy()
            word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(code))))
            keys, docs = [], []
            for run in RUN_SYMBOLS:
                n = len(code) - run + 1
                if n > 0:
                    whole = np.flatnonzero(word[:n] == word[run - 1 :])
                    keys.append(sum(code[whole + k].astype(np.int64) << 5 * (run - 1 - k) for k in range(run)) + (1 << 5 * run))
                    docs.append(row[word[whole]])
            if keys:
                both = np.unique(np.stack((np.concatenate(keys), np.concatenate(docs))), axis=1)
                key, at = np.unique(both[0], return_inverse=True)
                t = np.bincount(at, weight[both[1]] * toxic[both[1]], len(key))
                c = np.bincount(at, weight[both[1]] * ~toxic[both[1]], len(key))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(t), pa.array(c)], names=["word", "t", "c"])

    return _counted(rows, scan, "bigint")


def _run(key: int) -> str:
    """The symbols of a run as a text."""
    out = ""
    while key > 1:
        out = chr(64 + (key & 31)) + out
        key >>= 5
    return out


def _word_counts(rows: DataFrame) -> DataFrame:
    """The weights of documents with each word of at least three letters, as a text of symbols with its borders; t1 and
    c1 are those of the second half."""
    names = ["word", "t", "c", "t1", "c1"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            code, starts, row = units(batch.column("text"))
            whole = (code + 64).astype(np.uint8).tobytes().decode("latin-1")
            ends = np.append(starts[1:], len(code))
            toxic, weight, half = (batch.column(c).to_pylist() for c in ("toxic", "weight", "half"))
            sums: dict[str, list[float]] = {}
            for r, w in sorted({(r, whole[a:b]) for r, a, b in zip(row.tolist(), starts.tolist(), ends.tolist()) if b - a >= 5}):
                own = sums.setdefault(w, [0.0] * 4)
                for k in (0, 2)[: 1 + half[r]]:
                    own[k + (not toxic[r])] += weight[r]
            found = sorted(sums.items())
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), *(pa.array([v[k] for _, v in found], pa.float64()) for k in range(4))], names=names)

    return _counted(rows, scan, "string", "t1", "c1")


def _surprise(share: float):
    """How unlikely it is that a run's documents are so toxic by chance, as a logarithm."""
    n = F.col("t") + F.col("c")
    return F.col("t") * F.log(F.col("t") / n / share) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / n / (1 - share))).otherwise(0.0)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", most: int = SAMPLE_DOCUMENTS) -> Machine:
    """A machine from about ``most`` labelled documents of each class outside fold 0; whole texts are read.

    Without documents of both classes it takes nothing for toxic. Several labels of one key count as their largest;
    equal texts count once; null labels and texts are left out. The same rows give the same machine.
    """
    rows = _labelled(docs, labels, text, key, label, most)
    size = {r["toxic"]: r["w"] for r in rows.groupBy("toxic").agg(F.sum("weight").alias("w")).collect()}
    quiet = Machine(np.zeros(SYMBOLS**3, np.float32))
    if len(size) < 2:
        return quiet
    spark = docs.sparkSession
    counted = staged(_run_counts(rows).where("t > 0"), "runs")
    bound = float(np.log(counted.count() + 1) + SURPRISE)
    share = size[1] / (size[0] + size[1])
    marking = counted.where((F.col("t") > min(0.9, LIFT * share) * (F.col("t") + F.col("c"))) & (_surprise(share) > bound))
    runs = frozenset(_run(r["word"]) for r in marking.collect())  # each needs several of the sample's documents
    known = spark.sparkContext.broadcast(runs)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = [any(w[i : i + n] in known.value for n in RUN_SYMBOLS for i in range(len(w) - n + 1)) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(has, pa.bool_())], names=[*batch.schema.names, "has"])

    words = staged(_word_counts(rows).mapInArrow(mark, "word string, t double, c double, t1 double, c1 double, has boolean"), "words")
    marked = words.where("has").orderBy("word").collect()
    positive = [r["word"] for r in marked if r["t"] > WORD_SHARE * (r["t"] + r["c"])]
    alike = [r["word"] for r in marked if not r["t"] > WORD_SHARE * (r["t"] + r["c"])]
    clean = words.where((F.col("c") > 0) & ~F.col("has")).select("word", "c", "c1")
    own_half = {r["word"]: (r["t"] - r["t1"], r["c"] - r["c1"], r["t1"], r["c1"]) for r in marked}

    def took(found: list) -> list[str]:
        """Words of clean documents; how often each half has them is kept."""
        own_half.update((r["word"], (0.0, r["c"] - r["c1"], 0.0, r["c1"])) for r in found)
        return [r["word"] for r in found]

    negative = alike + took(clean.orderBy(F.xxhash64("word"), "word").limit(ROUND_WORDS).collect())
    if not positive or not negative:
        return quiet
    while True:
        machine = fit_words(positive, negative)
        give_back()  # the driver's, whose kernels are gone
        now, told = spark.sparkContext.broadcast(machine), spark.sparkContext.broadcast(frozenset(negative))

        def beyond(batches: Iterator[pa.RecordBatch], now=now, told=told) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                value = margins(*packed(batch.column(0).to_pylist()), now.value.weights, now.value.bias)
                out = np.array([w not in told.value for w in batch.column(0).to_pylist()], bool) & (value > MARGIN)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], names=["word", "c", "c1", "value"]).filter(pa.array(out))

        hard = clean.mapInArrow(beyond, "word string, c double, c1 double, value double").orderBy(F.desc("value"), "word").limit(ROUND_WORDS).collect()
        if not hard:
            break
        negative += took(hard)
    # each half's documents by a machine of the other half's words
    halves = []
    for k in (2, 0):
        good = [w for w in positive if own_half[w][k] > WORD_SHARE * (own_half[w][k] + own_half[w][k + 1])]
        bad = [w for w in negative if own_half[w][k + 1] > 0]
        halves.append(fit_words(good, bad) if good and bad else machine)
        give_back()
    broadcast = spark.sparkContext.broadcast(halves)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", STEP):
            half = batch.column("half").to_numpy()
            x = np.where((half == 0)[:, None], *(m.document(batch.column("text")) for m in broadcast.value))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(x[:, k]) for k in range(4))], names=["toxic", "top", "total", "many", "sure"])

    got = rows.mapInArrow(measure, "toxic int, top double, total double, many double, sure double").collect()
    got = sorted(tuple(r) for r in got)  # a row for each of the sample's texts
    machine.logistic = _logistic(np.array([r[1:] for r in got]), np.array([float(r[0]) for r in got]))
    return machine


def score(docs: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1, higher: likelier toxic) and predicted (1 from 0.5 on).

    Null and empty texts get the score of a text without words. Result columns replace columns of these names.
    """
    rest = docs.drop("score", "predicted")
    plain, broadcast = rest.columns, docs.sparkSession.sparkContext.broadcast(machine)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text, STEP):
            p = broadcast.value.score(batch.column(text))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in plain] + [pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=[*plain, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(rate, schema + ", score double, predicted int")
