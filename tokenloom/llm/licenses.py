"""Licence scan: sentences are mapped to known identifiers, and their sequence to ordered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.joins import lookup
from tokenloom.session import materialize

END = "\x00"  # stands behind the last sentence of every text
# A run of marks or white space is matched from its beginning and never given back, so each is read once.
MARKED_END = r"(?<![.!?;:])[.!?;:]++(?:\s++|\z)"
SENTENCE_END = MARKED_END + r"|(?<!\s)[^\S\n]*+\n\s*+"
HARD_END = MARKED_END + r"|\n\s*\n\s*"  # what a sentence broken over lines does not go across
NO_WORD = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"

# Sentences of public licences and their usual notices, by identifier.
SENTENCES = {
    1: "Released under the MIT License",
    2: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    3: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    4: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    10: "Licensed under the Apache License, Version 2.0",
    11: "Licensed under the Apache License, Version 2.0 (the \"License\")",
    12: "you may not use this file except in compliance with the License",
    13: "You may obtain a copy of the License at",
    14: "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    15: "See the License for the specific language governing permissions and limitations under the License",
    20: "This work is licensed under the GNU General Public License, version 3",
    21: "This program is free software",
    22: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    23: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version",
    24: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    30: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    31: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    32: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    33: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    40: "Licensed under CC BY-NC 4.0",
    41: "Licensed under CC BY 4.0",
    42: "Licensed under CC BY-SA 4.0",
    43: "This work is licensed under a Creative Commons Attribution 4.0 International License",
}

# Licence, and the sentence identifiers that must come in this
# order, others between them or not. A sentence may serve several rules.
RULES = [
    ("MIT", [1]),
    ("MIT", [2, 3, 4]),
    ("Apache-2.0", [10]),
    ("Apache-2.0", [11, 12, 13]),
    ("GPL-3.0-only", [20]),
    ("GPL-3.0-or-later", [21, 22, 24]),
    ("GPL-2.0-or-later", [21, 23, 24]),
    ("BSD-2-Clause", [30, 31, 32]),
    ("BSD-3-Clause", [30, 31, 32, 33]),
    ("CC-BY-NC-4.0", [40]),
    ("CC-BY-4.0", [41]),
    ("CC-BY-4.0", [43]),
    ("CC-BY-SA-4.0", [42]),
]
# A licence whose rule contains that of another: the lesser one is not reported beside it.
COVERS = [("BSD-3-Clause", "BSD-2-Clause")]


def sentences(text: Column) -> Column:
    """Normalised sentences: lower case, words parted by one blank; the end mark is last. Null has none but it."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    cut = F.regexp_replace(F.regexp_replace(lowered, SENTENCE_END, "\n"), NO_WORD, " ")
    return F.array_append(F.split(cut, "\n"), F.lit(END))


def wrapped_sentences(text: Column, known: list[str]) -> Column:
    """As `sentences`, and in front of its lines each known sentence that is broken over several.

    A single line break, comment signs behind it or not, is a blank there; a
    blank line, and a sentence mark before white space, end the sentence. It
    begins and ends with a line. `known` are normalised.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    cut = F.regexp_replace(F.regexp_replace(lowered, HARD_END, "\n\n"), NO_WORD, " ")
    cut = F.concat(F.lit("\n"), F.regexp_replace(cut, " *\n *", "\n"), F.lit("\n"))
    cut = F.regexp_replace(cut, "\n +| +\n", "\n")
    either = "|".join(s.replace(" ", r"[ \n]") for s in sorted(known, key=len, reverse=True))
    parts = F.split(F.regexp_replace(cut, rf"(?<=\n)(?:{either})(?=\n)", f"{END}$0{END}"), END)
    pieces = lambda x: F.split(x, "\n")
    broken = lambda x, k: (k % 2 == 1) & F.contains(x, F.lit("\n"))
    whole = lambda x: F.concat(F.array(F.translate(x, "\n", " ")), pieces(x))
    return F.array_append(F.flatten(F.transform(parts, lambda x, k: F.when(broken(x, k), whole(x)).otherwise(pieces(x)))), F.lit(END))


def in_order(ids: list[int]) -> str:
    """Pattern of paths `,1,2,` that hold `ids` in this order: each is taken at its first place and never given back."""
    return "^,(?>" + ")(?>".join(f"(?:.*?,)??{i}," for i in ids) + ")"


def sentence_table(spark: SparkSession, known: dict[int, str] | None = None) -> DataFrame:
    """sentence, id: the known sentences, normalised as texts are."""
    rows = spark.createDataFrame(list((known or SENTENCES).items()), "id int, raw string")
    rows = rows.select("id", F.array_join(F.filter(F.transform(sentences(F.col("raw")), lambda s: F.btrim(s)), lambda s: (s != "") & (s != END)), "\n").alias("sentence"))
    return rows


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    known: dict[int, str] | None = None,
    rules: list[tuple[str, list[int]]] | None = None,
) -> DataFrame:
    """key, sentence_ids, licenses: known sentences in order of place, and the licences whose rules they follow.

    One row per row of `docs`. Null, empty and unlicensed texts have empty
    lists. Rows that repeat key and text get the same lists; a null key is a key
    like any other. Sentences may be broken over lines. They meet the table in a join of checked size, and
    only known ones are shuffled.
    """
    spark = docs.sparkSession
    table = sentence_table(spark, known).union(spark.createDataFrame([(0, END)], "id int, sentence string"))
    table = materialize(table.select("sentence", "id"), "known_sentences")
    whole = [r["sentence"] for r in table.filter("id <> 0 and sentence <> ''").select("sentence").distinct().collect()]
    body = F.col(text).cast("string")
    rows = docs.select(
        F.struct(F.col(key).alias("id"), F.xxhash64(body).alias("copy")).alias("d"),
        F.posexplode(wrapped_sentences(body, whole)).alias("pos", "_raw"),
    )
    found = lookup(rows.select("d", "pos", F.btrim("_raw").alias("sentence")), table, ["sentence"], "inner")
    each = found.groupBy("d").agg(
        F.array_sort(F.collect_set(F.when(F.col("id") > 0, F.struct("pos", "id")))).alias("s"),
        F.sum(F.when(F.col("id") == 0, 1).otherwise(0)).alias("copies"),
    )
    each = each.select("d", F.transform("s", lambda x: x["id"]).alias("sentence_ids"), F.explode(F.sequence(F.lit(1), "copies")))
    path = F.concat(F.lit(","), F.array_join(F.col("sentence_ids").cast("array<string>"), ","), F.lit(","))
    named = F.array(*[F.when(path.rlike(in_order(order)), name) for name, order in rules or RULES])
    licenses = F.array_sort(F.array_distinct(F.filter(named, lambda x: x.isNotNull())))
    for more, less in COVERS:
        licenses = F.when(F.array_contains(licenses, more), F.array_remove(licenses, less)).otherwise(licenses)
    return each.select(F.col("d.id").alias(key), "sentence_ids", licenses.alias("licenses"))
