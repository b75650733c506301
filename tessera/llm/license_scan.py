"""Operator 9: license scans by diagonal voting.  DataFrame functions only.

All rolling word k-grams of a document are joined by hash to the positions of the same grams in the templates (a table of a
few hundred rows, broadcast) and confirmed on the words.  A copy of a template lies on a diagonal: document position minus
template position is constant.  Hits are counted per (document, template, diagonal); diagonals at most ``gap`` apart, as after
an inserted or deleted word, are merged; a merged span is verified when it covers at least ``min_cover`` of the
template's distinct gram positions.  The best cover is the score (1 for a document that holds a base phrase).

Base phrases are looked up in documents that contain their last word at all.  Only hits and one row per document are
shuffled.

Defined cases: null or wordless texts have no words, places, labels and score 0; rows that repeat id and text give one result
row, rows that share an id with different texts one each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.text import add_gram_hashes, alnum_words

# Phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of common licenses, (label, text).
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
               "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
            "version"),
    ("gpl", "Licensed under the GNU General Public License, version 3"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]


def template_grams(spark, templates: list[tuple[str, str]], k: int) -> DataFrame:
    """(h, t, label, at, gram, n_grams): one row per gram position of every template."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "t int, label string, text string")
    grams = add_gram_hashes(rows.withColumn("words", alnum_words(F.col("text"))), "words", "grams", k)
    return (grams.select("t", "label", "words", F.size("grams").alias("n_grams"), F.posexplode("grams").alias("at", "h"))
            .select("h", "t", "label", "at", F.slice("words", F.col("at") + 1, k).alias("gram"), "n_grams"))


def _places(words, parts: list[str], label: str):
    """Array of (at, label): where the words ``parts`` stand consecutively."""
    def here(i):
        same = F.lit(True)
        for j, part in enumerate(parts):
            same = same & F.coalesce(F.get(words, i + j) == part, F.lit(False))
        return same
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0)))
    return F.transform(F.filter(starts, here), lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))


def _base_places(words, phrases: dict[str, str]):
    """Array of (at, label) of all places of the phrases."""
    lasts = sorted({p.split()[-1] for p in phrases})
    found = [_places(words, phrase.split(), label) for phrase, label in phrases.items()]
    holds = F.lit(False)
    for last in lasts:
        holds = holds | F.array_contains(words, last)
    return F.when(holds, F.concat(*found)).otherwise(F.array().cast("array<struct<at:int,label:string>>"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES,
                 phrases: dict[str, str] = PHRASES, k: int = 3, gap: int = 3, min_cover: float = 0.6) -> DataFrame:
    """Per document: (id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans): the verified spans are
    (label, first, last, cover) with word positions."""
    marks = F.broadcast(template_grams(docs.sparkSession, templates, k))
    texts = docs.select(F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__tk"), alnum_words(F.col(text_col)).alias("__w"))
    places = add_gram_hashes(texts.withColumn("__base", _base_places(F.col("__w"), phrases)), "__w", "__g", k)
    # one extra entry per document, at position -1, carries what is known of the whole document
    entries = F.concat(F.array(F.lit(None).cast("long")), F.col("__g"))
    found = (places.select("__id", "__tk", "__w", "__base", F.posexplode(entries).alias("p", "h")).withColumn("p", F.col("p") - 1)
             .join(marks, "h", "left")
             .where((F.col("p") < 0) | (F.slice("__w", F.col("p") + 1, k) == F.col("gram")))
             .select("__id", "__tk", F.when(F.col("p") < 0, F.size("__w")).alias("n_words"),
                     F.when(F.col("p") < 0, F.col("__base")).alias("base"), "t", "label", "n_grams", "p", "at",
                     (F.col("p") - F.col("at")).alias("diag")))
    doc = ["__id", "__tk"]
    diagonals = found.groupBy(*doc, "t", "label", "n_grams", "diag").agg(
        F.max("n_words").alias("n_words"), F.max("base").alias("base"), F.collect_set("at").alias("ats"),
        F.min("p").alias("lo"), F.max("p").alias("hi"))
    line = Window.partitionBy(*doc, "t").orderBy("diag")
    far = F.coalesce(F.col("diag") - F.lag("diag").over(line) > gap, F.lit(False)).cast("int")
    merged = (diagonals.withColumn("far", far).withColumn("part", F.sum("far").over(line))
              .groupBy(*doc, "t", "part")
              .agg(F.max("n_words").alias("n_words"), F.max("base").alias("base"), F.max("label").alias("label"),
                   (F.size(F.array_distinct(F.flatten(F.collect_list("ats")))) / F.max("n_grams")).alias("cover"),
                   F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    good = F.col("t").isNotNull() & (F.col("cover") >= min_cover)
    span = F.struct("label", F.col("lo").alias("first"), (F.col("hi") + (k - 1)).alias("last"), "cover")
    out = (merged.groupBy(*doc)
           .agg(F.max("n_words").cast("long").alias("n_words"), F.max("base").alias("base"),
                F.max(F.when(good, F.col("cover"))).alias("best"), F.array_sort(F.collect_set(F.when(good, span))).alias("spans")))
    at, base_labels = F.col("base.at"), F.array_sort(F.array_distinct("base.label"))
    found_labels = F.array_sort(F.array_union(F.col("base.label"), F.col("spans.label")))
    return out.select(F.col("__id").alias(id_col), "n_words", F.size("base").cast("long").alias("n_base"),
                      F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
                      F.array_join(base_labels, ",").alias("base_labels"), F.array_join(found_labels, ",").alias("labels"),
                      F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"), "spans")


def _sql_words(text: str) -> str:
    return (f"list_filter(string_split_regex(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")


ORACLE = (r"""WITH tpl(t, label, text) AS (VALUES """
          + ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES)) + "),"
          + f"""
d AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
tw AS (SELECT t, label, {_sql_words('text')} AS w FROM tpl),
tg AS (SELECT t, label, len(w) - 2 AS n_grams, unnest(range(0, len(w) - 2)) AS tp,
  unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM tw),
dg AS (SELECT doc_id, unnest(range(0, len(w) - 2)) AS p,
  unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM d WHERE len(w) > 2),
h AS (SELECT doc_id, t, label, n_grams, tp, p - tp AS diag FROM dg JOIN tg USING (g)),
dd AS (SELECT DISTINCT doc_id, t, diag FROM h),
c AS (SELECT *, sum(far) OVER (PARTITION BY doc_id, t ORDER BY diag) AS part FROM (
  SELECT *, CASE WHEN diag - lag(diag) OVER (PARTITION BY doc_id, t ORDER BY diag) > 3 THEN 1 ELSE 0 END AS far FROM dd)),
m AS (SELECT doc_id, t, part, any_value(label) AS label, count(DISTINCT tp) / any_value(n_grams) AS cover
  FROM h JOIN c USING (doc_id, t, diag) GROUP BY ALL HAVING cover >= 0.6),
s AS (SELECT doc_id, list(DISTINCT label) AS ls, max(cover) AS best FROM m GROUP BY 1),
u AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
b AS (SELECT doc_id, i - 1 AS wp, CASE WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit'
    WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache'
    WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl' END AS label
  FROM u WHERE label IS NOT NULL),
bs AS (SELECT doc_id, count(*) AS n_base, min(wp) AS first_word, max(wp) AS last_word, list(DISTINCT label) AS ls FROM b GROUP BY 1)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(bs.ls), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bs.ls, []), coalesce(s.ls, [])))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN bs USING (doc_id) LEFT JOIN s USING (doc_id)""")
