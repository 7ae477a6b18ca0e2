"""License scans: phrases of whole words, and an exact set-similarity join of text blocks with license templates.

For a template of m words a block is a run of 2m words of the text, taken as a set, across line breaks; blocks begin at
every m-th word, so any m words on end stand in one. A template is found in a block if at least `THRESHOLD` of its words
are (containment). The join is exact: words are ordered by how many documents of the corpus hold them, rarest first; an
overlap of o words means that the first |T| - o + 1 words of the template and the first |B| - o + 1 of the block share
one (prefix filter), that the block has o words (length filter), and that enough words follow the shared one on either
side (positional filter). What passes is verified on the full sets.

Only built-in expressions and joins. The text is read once: each document leaves its counts, which template words it
holds, and the blocks that hold enough of them; that small table is stored and everything else works on it.
Templates are a parameter of a few rows, so their side is broadcast. Blocks are joined by word; a word that many blocks
share is only in a template's prefix if the template's other words are more frequent still, and adaptive execution
splits it.

Defined cases: null and empty texts have no words, no labels and score 0; repeated rows each give a row; an empty table
gives no rows; other columns are not carried. The score is 1 with a phrase, else the best containment found, else 0.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from mailloom.llm.common import stored

# --- fixed values: phrases of the contract, and notices of public licenses ------------
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
TEMPLATES = (
    ("gpl-3.0-notice", "this work is licensed under the gnu general public license version 3"),
    ("apache-2.0-notice", "licensed under the apache license version 2 0"),
    ("cc-by-nc-4.0-notice", "licensed under cc by nc 4 0"),
    ("mit-notice", "released under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-grant", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("rights-reserved", "copyright all rights reserved"),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation "
        "files the software to deal in the software without restriction including without limitation the rights to use copy modify "
        "merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
        "furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the software the software is provided as is without warranty of any kind "
        "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability "
        "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
        "other dealings in the software",
    ),
    (
        "isc-text",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies the software is provided as is and the "
        "author disclaims all warranties with regard to this software including all implied warranties of merchantability and "
        "fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages "
        "whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action "
        "arising out of or in connection with the use or performance of this software",
    ),
)
# ---------------------------------------------------------------------------------------
THRESHOLD = 0.8

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z lower-cased as far as words of ASCII letters can tell.

    Lower-casing all letters yields an ASCII letter of its own only for the Kelvin sign, which is replaced before.
    """
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))


def spaces(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))


def _sets(templates) -> list[tuple[str, list[str], int, int]]:
    """Label, distinct words, the overlap that reaches the threshold, and all words' number."""
    return [(label, words := sorted(set(text.split())), ceil(THRESHOLD * len(words) - 1e-9), len(text.split())) for label, text in templates]


def _blocks_of(size: int, own: list[tuple[list[str], int]]) -> Column:
    """The blocks for templates of one size that hold enough of their words."""
    listed = lambda words: F.array(*[F.lit(w) for w in words])
    known = listed(sorted({w for words, _ in own for w in words}))
    least = min(overlap for _, overlap in own)
    enough = F.lit(False)
    for words, overlap in own:  # the whole text must hold what a block is to hold
        enough = enough | (F.size(F.array_intersect("held", listed(words))) >= overlap)
    starts = F.sequence(F.lit(0), F.size("sequence") - 1, F.lit(size))
    blocks = F.transform(starts, lambda i: F.struct(F.lit(size).alias("size"), F.array_intersect(F.slice("sequence", i + 1, F.lit(2 * size)), known).alias("words")))
    kept = F.filter(blocks, lambda b: F.size(b["words"]) >= least)
    return F.when(enough & (F.size("sequence") > 0), kept).otherwise(F.array().cast("array<struct<size:int,words:array<string>>>"))


def _blocks(sets) -> Column:
    """All blocks of a text's words (column `sequence`) that can hold a template."""
    sizes = sorted({m for *_, m in sets})
    return F.concat(*[_blocks_of(size, [(words, overlap) for _, words, overlap, m in sets if m == size]) for size in sizes])


def profile(documents: DataFrame, phrases=PHRASES, templates=TEMPLATES, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts, places of phrases, template words held, and the blocks that hold enough of them.

    `words` is the text as its words between single spaces.
    """
    sets = _sets(templates)
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for _, words, _, _ in sets for w in words})])
    low = documents.select(F.col(doc).cast("long").alias("doc_id"), lowered(F.col(text)).alias("low"))
    rows = low.withColumn("words", F.regexp_replace(F.concat(F.lit(" "), F.col("low"), F.lit(" ")), _BREAK, " "))
    rows = rows.withColumns({"n_words": (spaces(F.col("words")) - 1).cast("long"), "held": F.array_intersect(F.split("words", " "), vocabulary)})
    parts = {
        label: F.when(F.contains("words", F.lit(f" {phrase} ")), F.split("words", f"(?<= )(?={phrase} )")) for phrase, label in phrases
    }
    rows = rows.withColumns({f"parts_{i}": part for i, part in enumerate(parts.values())})
    found = [F.col(f"parts_{i}") for i in range(len(phrases))]
    n_base = sum((F.coalesce(F.size(p) - 1, F.lit(0)) for p in found), F.lit(0)).cast("long")
    firsts = [F.when(p.isNotNull(), spaces(p[0]) - 1) for p in found]
    lasts = [F.when(p.isNotNull(), F.col("n_words") - spaces(F.element_at(p, -1))) for p in found]
    rows = rows.withColumn("sequence", F.when(F.col("n_words") > 0, F.split(F.btrim("words"), " ")).otherwise(F.array().cast("array<string>")))
    return rows.select(
        "doc_id",
        "n_words",
        n_base.alias("n_base"),
        F.least(*firsts, F.lit(None)).cast("long").alias("first_word"),
        F.greatest(*lasts, F.lit(None)).cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(p.isNotNull(), label) for p, label in zip(found, parts)])).alias("base"),
        "held",
        _blocks(sets).alias("blocks"),
    )


def similarity_join(blocks: DataFrame, frequency: DataFrame, templates=TEMPLATES) -> DataFrame:
    """block, label and containment of every pair that reaches the threshold.

    blocks: `block` (unique), `size` (of the templates it is for) and `words` (distinct, of their vocabulary); frequency:
    `word`, `n`.
    """
    spark = blocks.sparkSession
    sets = spark.createDataFrame([(label, w, overlap, m) for label, words, overlap, m in _sets(templates) for w in words], "label string, word string, overlap int, size int")
    # One row per vocabulary word.
    known = F.broadcast(sets.select("word").distinct().join(frequency, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n")))
    rarest_first = F.transform(F.array_sort(F.collect_list(F.struct("n", "word"))), lambda x: x["word"])
    ordered = sets.join(known, "word").groupBy("label", "overlap", "size").agg(rarest_first.alias("template"))
    prefixes = F.broadcast(
        ordered.select("label", "overlap", "size", "template", F.posexplode(F.slice("template", 1, F.size("template") - F.col("overlap") + 1)).alias("at", "word"))
    )
    sorted_blocks = blocks.select("block", "size", F.explode("words").alias("word")).join(known, "word").groupBy("block", "size").agg(rarest_first.alias("words"))
    tokens = sorted_blocks.select("block", "size", "words", F.posexplode("words").alias("place", "word"))
    held, left, right = F.size("words"), F.size("words") - F.col("place"), F.size("template") - F.col("at")
    candidates = (
        tokens.join(prefixes, ["word", "size"])
        .where(held >= F.col("overlap"))  # length
        .where(F.col("place") <= held - F.col("overlap"))  # prefix of the block
        .where(F.least(left, right) >= F.col("overlap") - F.least("place", "at"))  # position
        .select("block", "label", "words", "template", "overlap")
        .distinct()
    )
    shared = F.size(F.array_intersect("words", "template"))
    return candidates.where(shared >= F.col("overlap")).select("block", "label", (shared / F.size("template")).alias("containment"))


def scan(documents: DataFrame, phrases=PHRASES, templates=TEMPLATES, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, phrase places, base labels, all labels, and the score of every document."""
    rows = stored(profile(documents, phrases, templates, doc, text).withColumn("row", F.monotonically_increasing_id()), "licenses")
    frequency = rows.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    found = rows.select("row", F.posexplode("blocks").alias("place", "b"))
    blocks = found.select(F.struct("row", "place").alias("block"), "b.size", "b.words")
    matches = similarity_join(blocks, frequency, templates)
    own = matches.groupBy(F.col("block.row").alias("row")).agg(F.collect_set("label").alias("similar"), F.max("containment").alias("best"))
    none = F.array().cast("array<string>")
    joined = rows.join(own, "row", "left").withColumn("similar", F.coalesce("similar", none))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "similar")), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
