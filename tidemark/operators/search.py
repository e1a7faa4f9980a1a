"""A postings table over labelled texts, ranked queries and excerpts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import fold, fold_latin, squeeze

WORDS = r"(?U)(\w+)"


def corpus(df: DataFrame, key: str, texts: dict[str, tuple[Column, int]]) -> DataFrame:
    """key, label, text and weight for each text that is not blank; of equal texts the first label stays."""
    cells = F.array(*(F.struct(F.lit(k).alias("label"), squeeze(c).alias("text"), F.lit(w).alias("weight")) for k, (c, w) in texts.items()))
    filled = F.filter(cells, lambda x: x["text"] != "")
    first = F.filter(filled, lambda x, i: ~F.exists(F.slice(filled, F.lit(1), i), lambda y: y["text"] == x["text"]))
    return df.select(key, F.explode(first).alias("x")).select(key, "x.label", "x.text", "x.weight")


def postings(docs: DataFrame, key: str, text: Column, weight: Column | None = None, folded: bool = False) -> DataFrame:
    """term, key and the term's weight in the document."""
    plain = fold(text) if folded else F.lower(text)
    each = F.lit(1) if weight is None else weight
    terms = docs.select(key, F.explode(F.regexp_extract_all(plain, F.lit(WORDS), F.lit(1))).alias("term"), each.alias("w"))
    return terms.groupBy("term", key).agg(F.sum("w").cast("long").alias("weight"))


def statistics(index: DataFrame) -> DataFrame:
    """documents and weight of every term of the index."""
    return index.groupBy("term").agg(F.count("*").alias("documents"), F.sum("weight").alias("weight"))


def search(index: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """Documents that hold every term, with the sum of the terms' weights."""
    wanted = list(dict.fromkeys(t.lower() for t in terms))
    hits = index.where(F.col("term").isin(*wanted)).groupBy(key).agg(F.count("*").alias("found"), F.sum("weight").alias("score"))
    return hits.where(F.col("found") == len(wanted)).select(key, "score")


#: Places that the title's words count as, beside the one they have.
TITLE_WEIGHT = 2


def titled_postings(docs: DataFrame, key: str, title: Column, text: Column, weight: int = TITLE_WEIGHT) -> DataFrame:
    """Postings over title and text, without accents; a word of the title counts ``weight`` times more."""
    both = F.array(F.struct(title.alias("t"), F.lit(1 + weight).alias("w")), F.struct(text.alias("t"), F.lit(1).alias("w")))
    each = docs.select(key, F.explode(both).alias("x"))
    return postings(each, key, F.col("x.t"), F.col("x.w"), folded=True)


def excerpt(text: Column, term: str, most: int = 240) -> Column:
    """Up to ``most`` characters around the first place of the term, a third of them before it; null without it.

    Case and the accents of Western European letters don't matter. A shorter text is given whole; a longer one is cut
    between words, with … where something is left out.
    """
    plain = squeeze(text)
    at = F.instr(fold_latin(plain), F.lit(term.lower().translate(str.maketrans("áàâäãéèêëíìîïóòôöõúùûüñç", "aaaaaeeeeiiiiooooouuuunc"))))
    wanted = F.greatest(at - most // 3, F.lit(1))
    rest = F.substring(plain, wanted, F.length(plain))
    blank = F.instr(rest, " ")
    start = F.when(wanted == 1, 1).when((blank > 0) & (wanted + blank - 1 < at), wanted + blank).otherwise(F.lit(1))
    tail = F.substring(plain, start, F.lit(most))
    cut = F.when(start + most > F.length(plain), tail).otherwise(F.regexp_replace(tail, r" [^ ]*$", ""))
    before, after = F.when(start > 1, "…").otherwise(""), F.when(start + F.length(cut) <= F.length(plain), "…").otherwise("")
    return F.when(at > 0, F.when(F.length(plain) <= most, plain).otherwise(F.concat(before, cut, after)))


def first_excerpt(contexts: Column, term: str, most: int = 240) -> Column:
    """The excerpt of the first context that holds the term."""
    return F.try_element_at(F.filter(F.transform(contexts, lambda c: excerpt(c, term, most)), lambda x: x.isNotNull()), F.lit(1))
