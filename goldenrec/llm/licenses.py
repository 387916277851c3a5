"""License scans with DataFrame functions alone: a positional rare-token index.

A text's words are looked up in the vocabulary of some templates. Files that
hold all words of some mandatory phrase go on, with the positions of their
template words; texts are read once and never shuffled. Template postings
(word, template, position) are joined to those positions: each match votes for
an alignment, the file position where the template would begin. An alignment is
proposed if enough of the rarest words of the template's mandatory phrase
(highest inverse document frequency over all documents) agree on it by relative
position, and stands if the whole phrase is there word by word. So what else a
file holds never costs a phrase its votes.

The templates are a fixed list, so their postings are a few hundred rows
whatever the data; they alone are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.llm.text import ascii_lower, text_of
from goldenrec.session import materialize

#: What separates words once A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """label; words of the notice; the phrase of it that must be there."""
    label: str
    notice: str
    key: str


# Phrases that count wherever their words stand together.
BASE = (
    Template("mit", "mit license", "mit license"),
    Template("apache", "apache license", "apache license"),
    Template("gpl", "general public license", "general public license"),
)

# Openings of well-known notices, as words.
TEMPLATES = (
    Template("mit", "released under the mit license", "under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             "permission is hereby granted free of charge"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    Template("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("cc0-1.0", "licensed under cc0 1 0", "cc0 1 0"),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), BETWEEN, -1), lambda w: w != "")


def _vocabulary(templates: tuple[Template, ...]) -> list[str]:
    return sorted({w for t in templates for w in t.notice.split()})


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def scan(docs: DataFrame, templates: tuple[Template, ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_words, present, hits) for each row of ``docs``: template
    words it holds, and (pos, word) of them if it holds all words of a
    mandatory phrase."""
    vocabulary = _vocabulary(templates)
    rows = docs.select(F.col(id_col).alias("doc_id"), words_of(text_of(text_col)).alias("words"))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), "words", F.array_intersect("words", _strings(vocabulary)).alias("present"))
    phrases = {frozenset(t.key.split()) for t in templates}
    whole = F.lit(False)
    for phrase in sorted(map(sorted, phrases)):
        whole = whole | (F.size(F.array_intersect("present", _strings(phrase))) == len(phrase))
    hit = F.transform("words", lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("pos"), w.alias("word"))))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", "present",
                       F.when(whole, F.filter(hit, lambda x: x.isNotNull())).alias("hits"))


def postings(spark: SparkSession, base: tuple[Template, ...], templates: tuple[Template, ...], df: dict[str, int], rare: int) -> DataFrame:
    """(template, label, is_base, word, at, in_key, n_words, n_key, rarity,
    n_rare) for each word of each template; rarity ranks the ``rare`` rarest
    distinct words of its phrase by inverse document frequency (0 the rarest,
    ties by word), where they stand in the phrase, and is NULL elsewhere."""
    rows = []
    for k, t in enumerate(base + templates):
        notice, key = t.notice.split(), t.key.split()
        begin = next(i for i in range(len(notice)) if notice[i:i + len(key)] == key)
        rank = {w: i for i, w in enumerate(sorted(set(key), key=lambda w: (df.get(w, 0), w))[:rare])}
        in_key = [begin <= i < begin + len(key) for i in range(len(notice))]
        rows += [(k, t.label, k < len(base), w, i, in_key[i], len(notice), len(key), rank.get(w) if in_key[i] else None, len(rank)) for i, w in enumerate(notice)]
    return spark.createDataFrame(rows, "template int, label string, is_base boolean, word string, at int, in_key boolean, n_words int, n_key int, rarity int, n_rare int")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(labels), ",")


def scan_licenses(docs: DataFrame, base: tuple[Template, ...] = BASE, templates: tuple[Template, ...] = TEMPLATES, rare: int = 4, agree: int = 2,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score) for each row of ``docs``.

    Words are runs of digits, a-z (A-Z lower-cased) and signs beyond ASCII.
    n_base counts all places of the base phrases, first_word and last_word are
    their least and greatest begin (NULL without any). A template gives its
    label wherever its mandatory phrase stands, whatever else the text holds;
    alignments are proposed by ``agree`` of the phrase's ``rare`` rarest words
    (all of them, if there are fewer). score is the greatest share of a verified template's words
    that stand in place, 0 without any. labels holds base labels too; empty if
    there are none.

    NULL texts count as empty: no words, no labels. Repeated rows and NULL ids
    stay. Other columns are not read, so names cannot clash. An empty table
    gives an empty result.
    """
    found = materialize(scan(docs, base + templates, id_col, text_col), "licenses")
    vocabulary = _vocabulary(base + templates)
    df = dict(found.select(F.explode("present").alias("word")).groupBy("word").count().collect())  # at most the vocabulary
    index = F.broadcast(postings(docs.sparkSession, base, templates, {w: df.get(w, 0) for w in vocabulary}, rare))

    hits = found.filter(F.size("hits") > 0).select("row", F.explode("hits").alias("hit")).select(
        "row", F.col("hit.pos").alias("pos"), F.col("hit.word").alias("word"))
    votes = hits.join(index, "word").withColumn("begin", F.col("pos") - F.col("at"))
    at = votes.groupBy("row", "template", "label", "is_base", "n_words", "n_key", "n_rare", "begin").agg(
        F.count(F.lit(1)).alias("in_place"), F.sum(F.col("in_key").cast("int")).alias("key_in_place"), F.collect_set("rarity").alias("voted"))
    sure = at.filter((F.size("voted") >= F.least(F.lit(agree), "n_rare")) & (F.col("key_in_place") == F.col("n_key")))
    base_place, own = F.col("is_base"), ~F.col("is_base")
    summed = sure.groupBy("row").agg(
        F.count_if(base_place).alias("n_base"),
        F.min(F.when(base_place, F.col("begin"))).cast("long").alias("first_word"),
        F.max(F.when(base_place, F.col("begin"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base_place, F.col("label"))).alias("base_set"),
        F.collect_set("label").alias("label_set"),
        F.max(F.when(own, F.col("in_place") / F.col("n_words"))).alias("score"))
    return found.select("row", "doc_id", "n_words").join(summed, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce(_joined(F.col("base_set")), F.lit("")).alias("base_labels"),
        F.coalesce(_joined(F.col("label_set")), F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
