"""Licence scan: a positional index of rare licence words. Built-in functions only.

Templates (phrases) are cut into words; each template is looked up by its words of highest IDF among
the templates and the corpus' own counts of those words. A posting says at which place of a template a
word stands. A file's occurrences of a looked-up word, less that place, give where the template would
begin; a begin that all looked-up words agree on is a candidate, and the words there must be the whole
phrase. The postings are a fixed, small table; the only shuffles are of candidates and of counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# Phrases of the contract, and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Further phrases that public licence texts and notices carry, and labels for them.
FURTHER = {
    "permission is hereby granted free of charge": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu general public license": "gpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "boost",
    "creative commons attribution": "cc-by",
    "this is free and unencumbered software": "unlicense",
    "spdx license identifier": "spdx",
    "all rights reserved": "proprietary",
}


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, in order. Null: none."""
    spaced = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def postings(templates: dict[str, str], base: set[str], counts: dict[str, int], looked_up: int = 2) -> list[tuple]:
    """(word, place, phrase, label, base, words of the phrase): the rarest words of every phrase.

    ``counts``: documents that hold each word; words are rare by them, then by how few phrases use them.
    """
    use = {}
    for phrase in templates:
        for word in set(phrase.split()):
            use[word] = use.get(word, 0) + 1
    rows = []
    for phrase, label in templates.items():
        words = phrase.split()
        rare = sorted(range(len(words)), key=lambda i: (counts.get(words[i], 0), use[words[i]], i))[:looked_up]
        rows += [(words[i], i, phrase, label, phrase in base, words) for i in sorted(rare)]
    return rows


def scan(docs: DataFrame, base: dict[str, str] = BASE, further: dict[str, str] = FURTHER,
         key: str = "doc_id", text: str = "text", looked_up: int = 2) -> DataFrame:
    """key, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    A place is (start, phrase, label, base) of a phrase whose words stand consecutively, words counted
    from 0. Base phrases give n_base, first_word (smallest start), last_word (largest start) and
    base_labels; all phrases give labels. score: the share of the found phrases' IDF in that of the
    rarest phrase, 0 without any, 1 at most. Null and empty texts have no words. Each row is scanned by
    itself, repeated rows and null keys too. Templates are a parameter, so their postings are bounded
    by it; corpus counts cover all documents.
    """
    templates = dict(further) | dict(base)
    vocabulary = sorted({w for phrase in templates for w in phrase.split()})
    rows = docs.select(F.col(key).alias("id"), words_of(F.col(text)).alias("words"))
    # Documents with each licence word, over the whole corpus: one row, one counter a word.
    found = rows.select(F.array_intersect("words", F.array(*map(F.lit, vocabulary))).alias("has"))
    total = found.agg(F.count("*").alias("n"), *[
        F.count_if(F.array_contains("has", w)).alias(f"w{i}") for i, w in enumerate(vocabulary)
    ]).first()
    counts = {w: total[f"w{i}"] for i, w in enumerate(vocabulary)}
    idf = {w: _log((1 + total["n"]) / (1 + counts[w])) for w in vocabulary}
    weight = {phrase: sum(idf[w] for w in phrase.split()) for phrase in templates}
    most = max(weight.values(), default=0.0) or 1.0
    index: dict[str, list[tuple]] = {}
    for word, place, phrase, label, is_base, words in postings(templates, set(base), counts, looked_up):
        index.setdefault(word, []).append((place, phrase, label, is_base, words))
    keyed = rows.withColumn("has", F.array_intersect("words", F.array(*map(F.lit, sorted(index)))))
    places = F.array_distinct(F.flatten(F.array(*[
        _begins(F.col("words"), F.col("has"), phrase, label, phrase in base, index, weight[phrase] / most)
        for phrase, label in templates.items()
    ])))
    out = keyed.withColumn("places", F.when(F.size("has") > 0, places).otherwise(F.array().cast(PLACE)))
    base_places = F.filter("places", lambda p: p["base"])
    starts = F.transform(base_places, lambda p: p["start"])
    return out.select(
        F.col("id").alias(key),
        F.size("words").cast("long").alias("n_words"),
        F.size(base_places).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base_places).alias("base_labels"),
        _labels(F.col("places")).alias("labels"),
        F.least(F.lit(1.0), F.aggregate(
            F.array_distinct(F.transform("places", lambda p: F.struct(p["phrase"], p["weight"]))),
            F.lit(0.0), lambda sum_, p: sum_ + p["weight"])).alias("score"),
        "places",
    )


PLACE = "array<struct<start: bigint, phrase: string, label: string, base: boolean, weight: double>>"


def _log(x: float) -> float:
    from math import log

    return log(x)


def _labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def _begins(words: Column, has: Column, phrase: str, label: str, is_base: bool, index: dict, weight: float) -> Column:
    """Places of one phrase: begins on which its looked-up words agree, verified word by word."""
    parts = phrase.split()
    looked_up = [(w, p) for w in index for p, other, *_ in index[w] if other == phrase]
    numbered = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))

    def begins(word: str, place: int) -> Column:
        at = F.filter(numbered, lambda x: x["w"] == word)
        return F.transform(at, lambda x: x["i"] - place)

    agreed = begins(*looked_up[0])
    for other in looked_up[1:]:
        agreed = F.array_intersect(agreed, begins(*other))
    whole = F.filter(agreed, lambda at: (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, len(parts))
                                                     == F.array(*map(F.lit, parts))))
    made = F.transform(whole, lambda at: F.struct(
        at.cast("long").alias("start"), F.lit(phrase).alias("phrase"), F.lit(label).alias("label"),
        F.lit(is_base).alias("base"), F.lit(weight).alias("weight")))
    needed = [F.array_contains(has, w) for w in {w for w, _ in looked_up}]
    all_there = needed[0]
    for one in needed[1:]:
        all_there = all_there & one
    return F.when(all_there, made).otherwise(F.array().cast(PLACE))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("places")


