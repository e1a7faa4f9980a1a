"""Personal data by patterns, and information-theoretic sanitisation of what gives it away.

Addresses, numbers and phones are found by fixed patterns, secrets (keys, tokens) by the information that a string of
letters and digits holds. Protected entities are single values, and each kind of them. Over the whole corpus, words
near each entity are counted with it and without it. A word that makes the entity likely (its share of documents that
also hold the entity near it) and far likelier than by chance (normalised pointwise mutual information) discloses it;
such words are marked wherever they stand, then removed or put under a general name. A word that gives away no value but
only what kind of value stands beside it (the word before keys, say) is marked as a label and stays. Copies of one passage
count as one piece of evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from xxhash import xxh3_64_intdigest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sieve, sifted, staged, steps

KINDS = ("email", "ip", "card", "phone", "secret", "term", "label")
SECRET, TERM, LABEL = 4, 5, 6
#: Symbols of a secret at least, and its information: length times the entropy of its symbols, in bits.
SECRET_SYMBOLS, SECRET_BITS = 20, 64.0
#: Code points on each side of a protected value whose words count as near it.
NEAR = 80
#: Different passages that must hold word and value together before the word may disclose it.
LEAST_PASSAGES = 3
#: Least share of a word's documents that hold the value near it, and least normalised mutual information (0 to 1).
LEAST_SHARE, LEAST_INFORMATION = 0.5, 0.5
#: From this share on a disclosing word is removed; below it is generalised.
REMOVE_SHARE = 0.9
#: Words marked in one pass over the documents; more words take more passes, beside each other.
BLOCK_WORDS = 100_000
#: Words whose membership a task remembers; then it starts anew.
REMEMBERED = 1 << 19

# fixed values: what the patterns are
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W\d_]{4,}")
_SECRET = re.compile(rf"[A-Za-z0-9+/_-]{{{SECRET_SYMBOLS},}}")


def luhn(digits: str) -> bool:
    """Whether the check digit is right: every second digit from the right counts double."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that don't overlap. Each has one @, so the search goes from one to the next."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            floor = found.end()
        at = text.find("@", found.end() if found else at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(x[-4:]) <= 255 and not x[:-3].strip("0") for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def protected_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base matches and of secrets that touch none, in order."""
    out = base_spans(text)
    base, at = out[:], 0
    for m in _SECRET.finditer(text):
        a, b = m.span()
        while at < len(base) and base[at][2] <= a:
            at += 1
        if (at == len(base) or base[at][0] >= b) and _information(m[0]) >= SECRET_BITS:
            out.append((a, SECRET, b))
    return sorted(out)


def _information(symbols: str) -> float:
    """Bits of a string of letters and digits by how often each symbol is in it; 0 without both or with a plain word in it."""
    if not _DIGIT.search(symbols) or not any(c.isalpha() for c in symbols) or max(map(len, re.findall(r"[^0-9]+", symbols))) > 12:
        return 0.0
    n = np.array(list(Counter(symbols).values()), float)
    return float(-(n * np.log2(n / n.sum())).sum())


def _value(text: str, kind: int) -> str:
    return f"{kind}:{text.lower() if kind < 2 else text if kind == SECRET else ''.join(c for c in text if c.isdigit())}"


def _outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[str]:
    """The words, in small letters, that no base match touches; only these can be marked."""
    covered = np.zeros(len(text) + 1, bool)
    for a, _, b in spans:
        covered[a:b] = True
    return (m[0].lower() for m in _TERM.finditer(text) if not covered[m.start() : m.end()].any())


def evidence(docs: DataFrame, text: str = "text", kinds: bool = False) -> DataFrame:
    """value and word (hashed value, small letters), documents that have the word near the value, and passages.

    A row without a word has the documents that hold the value at all. With ``kinds``, each kind of value counts as a
    value too.
    Words that are part of the value count like all others: beside an address the name in it gives most away.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            found: Counter = Counter()
            for x in batch.column(text).to_pylist():
                spans = protected_spans(x) if x else []
                pairs: dict[tuple[int, str], set[int]] = {}
                values = set()
                for start, kind, end in spans:
                    before = x[max(0, start - NEAR) : start].lower()
                    after = x[end : end + NEAR].lower()
                    # a word cut off by the border of the stretch is left out
                    words = {m[0] for m in _TERM.finditer(before) if m.start() or start <= NEAR} | {m[0] for m in _TERM.finditer(after) if m.end() < len(after) or end + NEAR >= len(x)}
                    passage = xxh3_64_intdigest(" ".join(sorted(words))) >> 1
                    for value in (xxh3_64_intdigest(_value(x[start:end], kind)) >> 1, kind)[: 1 + kinds]:
                        values.add(value)
                        for w in words:
                            pairs.setdefault((value, w), set()).add(passage)
                for value in values:
                    found[value, None, 0] += 1
                # the document counts with one of its passages, so that passages add up to documents
                for (value, w), passages in pairs.items():
                    first = min(passages)
                    for passage in passages:
                        found[value, w, passage] += passage == first
            if found:
                value, word, passage = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(value, pa.int64()), pa.array(word, pa.string()), pa.array(passage, pa.int64()), pa.array(list(found.values()), pa.int64())], names=["value", "word", "passage", "n"])

    rows = docs.select(text).mapInArrow(scan, "value bigint, word string, passage bigint, n bigint")
    by_passage = rows.groupBy("value", "word", "passage").agg(F.sum("n").alias("n"))
    return by_passage.groupBy("value", "word").agg(F.sum("n").alias("joint"), F.count("*").alias("passages"))


def _blocks(words: DataFrame, most: int = BLOCK_WORDS) -> Iterator[dict]:
    """share and label by word, at most about ``most`` words at once; words are no labels unless it is said."""
    words = words if "label" in words.columns else words.withColumn("label", F.lit(False))
    n = max(1, -(-words.count() // most))
    for b in range(n):
        yield {r["word"]: (r["share"], r["label"]) for r in words.where(F.pmod(F.xxhash64("word"), F.lit(n)) == b).collect()}


def _document_counts(docs: DataFrame, words: DataFrame, text: str) -> DataFrame:
    """word and how many documents hold it outside protected spans, over all documents, in one pass.

    A sieve over the hashed words, as large as their number demands, lets few others through; these are counted too.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([xxh3_64_intdigest(w) >> 1 for w in batch.column(0).to_pylist()], pa.int64())], names=["id"])

    bits = docs.sparkSession.sparkContext.broadcast(sieve(staged(words.select("word").mapInArrow(number, "id bigint"), "wanted")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bool] = {}
        total: Counter = Counter()

        def told() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in steps(batches, text):
            for x in batch.column(text).to_pylist():
                held = set(_TERM.findall(x.lower())) if x else set()
                fresh = [w for w in held if w not in known]
                if fresh:
                    if len(known) > REMEMBERED:
                        known.clear()
                        fresh = list(held)
                    ids = np.array([xxh3_64_intdigest(w) >> 1 for w in fresh], np.int64)
                    known.update(zip(fresh, sifted(ids, bits.value).tolist()))
                held = {w for w in held if known[w]}
                if held and (spans := protected_spans(x)):
                    held = held.intersection(_outside(x, spans))
                total.update(held)
            if len(total) > REMEMBERED // 4:
                yield told()
        yield told()

    return docs.select(text).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def disclosing_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, share and label: words that disclose some protected entity, with the largest share of their documents, and
    whether they disclose kinds of values only."""
    seen = staged(evidence(docs, text, kinds=True).where(F.col("word").isNull() | (F.col("passages") >= LEAST_PASSAGES)), "evidence")
    pairs = seen.where("word is not null")
    if pairs.isEmpty():
        return docs.sparkSession.createDataFrame([], "word string, share double, label boolean")
    total = docs.count()
    words = pairs.select("word").distinct().withColumn("share", F.lit(0.0))
    counts = staged(_document_counts(docs, words, text), "counts")
    values = seen.where("word is null").select("value", F.col("joint").alias("of_value"))
    both = pairs.join(counts, "word").join(values, "value")
    share = F.col("joint") / F.greatest("n", "joint")
    joint = F.col("joint") / total
    information = F.log(share / (F.col("of_value") / total)) / F.greatest(-F.log(joint), F.lit(1e-9))
    return staged(both.where((share >= LEAST_SHARE) & (information >= LEAST_INFORMATION)).groupBy("word").agg(F.max(share).alias("share"), F.min(F.col("value") < len(KINDS)).alias("label")), "disclosing")


def _terms(x: str, spans: list[tuple[int, int, int]], disclosing: dict) -> list[tuple[int, int, float, bool]]:
    """(start, end, share, label) of the disclosing words of a text that touch no protected span."""
    small = x.lower()
    if len(small) != len(x):  # letters whose small form is longer: word by word
        return [(m.start(), m.end(), *disclosing[m[0].lower()]) for m in _TERM.finditer(x) if m[0].lower() in disclosing and not any(a < m.end() and m.start() < b for a, _, b in spans)]
    if disclosing.keys().isdisjoint(_TERM.findall(small)):
        return []
    covered = np.zeros(len(x) + 1, bool)
    for a, _, b in spans:
        covered[a:b] = True
    return [(m.start(), m.end(), *disclosing[m[0]]) for m in _TERM.finditer(small) if m[0] in disclosing and not covered[m.start() : m.end()].any()]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])


def _marked(batch: pa.RecordBatch, plain: list[str], text: str, terms) -> pa.RecordBatch:
    """The rows with their spans; ``terms`` gives those of a row beside the protected ones."""
    rows = []
    for k, x in enumerate(batch.column(text).to_pylist()):
        spans = protected_spans(x) if x else []
        found = [(a, kind, b, None) for a, kind, b in spans] + [(a, LABEL if label else TERM, b, share) for a, b, share, label in terms(k, x, spans)]
        rows.append([{"kind": KINDS[kind], "start": a, "end": b, "share": share} for a, kind, b, share in sorted(found, key=lambda s: s[:3])])
    return pa.RecordBatch.from_arrays([batch.column(c) for c in plain] + [pa.array(rows, pa.list_(_SPAN))], names=[*plain, "spans"])


def find(docs: DataFrame, text: str = "text", words: DataFrame | None = None) -> DataFrame:
    """``docs`` with spans: an array of (kind, start, end, share), in code points, by start and then kind.

    ``words`` are what disclosing_words gives (by default that of ``docs``). Null texts count as empty, repeated rows
    are marked alike. Disclosing words inside protected spans are not marked again. A column named spans is replaced.
    """
    words = disclosing_words(docs, text) if words is None else words
    rest = docs.drop("spans")
    plain, spark = rest.columns, docs.sparkSession
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest.schema) + "spans array<struct<kind: string, start: bigint, end: bigint, share: double>>"
    blocks = [spark.sparkContext.broadcast(block) for block in _blocks(words)]
    if len(blocks) == 1:

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            disclosing = blocks[0].value
            for batch in steps(batches, text):
                yield _marked(batch, plain, text, lambda _, x, spans: _terms(x, spans, disclosing) if x and disclosing else [])

        return rest.mapInArrow(mark, schema)

    at = "_row" + "_" * max(map(len, plain))  # longer than any name there
    kept = staged(rest.withColumn(at, F.monotonically_increasing_id()), "texts")
    term, found = "array<struct<start: bigint, end: bigint, share: double, label: boolean>>", None
    for block in blocks:

        def meet(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, text):
                rows = [(r, [{"start": a, "end": b, "share": s, "label": e} for a, b, s, e in _terms(x, protected_spans(x), block.value)]) for r, x in zip(batch.column(at).to_pylist(), batch.column(text).to_pylist()) if x]
                rows = [r for r in rows if r[1]]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.struct([*list(_SPAN)[1:], pa.field("label", pa.bool_())])))], names=[at, "terms"])

        own = kept.select(at, text).mapInArrow(meet, f"{at} bigint, terms {term}")
        found = own if found is None else found.unionByName(own)
    found = staged(found, "terms").groupBy(at).agg(F.flatten(F.collect_list("terms")).alias("terms" + at))
    joined = kept.join(found, at, "left").select(*plain, "terms" + at)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            terms = batch.column("terms" + at).to_pylist()
            yield _marked(batch, plain, text, lambda k, _x, _s: [(t["start"], t["end"], t["share"], t["label"]) for t in terms[k] or ()])

    return joined.mapInArrow(unite, schema)


def sanitise(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with every span of ``find`` replaced by its kind in brackets; strongly disclosing words are removed, labels
    stay as they are.

    Overlapping spans are replaced together by the kind of the first. Texts without spans and nulls stay as they are.
    """

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, out = batch.schema.get_field_index(text), []
            for x, found in zip(batch.column(text).to_pylist(), batch.column(spans).to_pylist()):
                if x and found:
                    parts, at = [], 0
                    for s in found:
                        if s["kind"] == "label":
                            continue
                        if s["start"] >= at:
                            gone = s["kind"] == "term" and s["share"] >= REMOVE_SHARE
                            parts += [x[at : s["start"]], "" if gone else f"[{s['kind'].upper()}]"]
                        at = max(at, s["end"])
                    x = "".join([*parts, x[at:]])
                out.append(x)
            yield batch.set_column(place, batch.schema.field(place), pa.array(out, batch.schema.field(place).type))

    return docs.mapInArrow(replace, docs.schema)
