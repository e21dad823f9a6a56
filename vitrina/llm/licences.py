"""Licence scan by a trained paragraph classifier, in DataFrame operations only.

Every line of every document is a paragraph, and so are the lines between two
blank lines, joined, for notices that are wrapped. Paragraphs without any cue
word of the notices or name of a family are unknown by definition; the others get sparse hashed features (words
and word pairs), and a multinomial logistic regression names a licence family
or "unknown". It is trained on altered copies of template notices, on ordinary
lines of the corpus and on sentences that use the same words for other things.
The probability asked of a family is calibrated on rows the training didn't
see; a prediction counts only if comparing word pairs with the family's
templates confirms it: the notice names the family, and no notice of a licence
outside the families is as close.

Defined results: a null or empty text has no paragraph; a document's families
are listed in alphabetical order, its lines (from 0) in text order; two
families that are equally likely go to the first in the list; repeated rows
are scanned each; an empty table gives no rows. A line that overlaps another
family as much as its own is not clear (a part of a wrapped GPL header, say):
the lines between the blank lines around it, without the clear ones, are joined
and scored, and a clear result stands at the first of them with a cue. A line
that isn't clear belongs to a clear notice of such a family between the same
blank lines; without one it keeps its own.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.shared import id_text, written

# Short notices by which public licences are declared.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "This software is released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
        "Released under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "Released under the GNU LGPL, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "Licensed under the MIT license.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "Released under the MPL, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
UNKNOWN = "unknown"
# Sentences with cue words that declare no licence.
OTHER = [
    "She renewed her driving licence at the town hall.",
    "A fishing license costs ten dollars for residents of the state.",
    "The copyright office is closed on public holidays.",
    "The warranty covers repairs for two years after purchase.",
    "The general public is not permitted to enter the building without a license.",
    "He was granted permission to leave early on Friday.",
    "Version 2.0 of the report was released under embargo last week.",
    "The apache helicopter is licensed to several other countries.",
    "MIT released a study about software used by students.",
    "The tax agency asked them to redistribute the funds and modify the terms of the contract.",
    "Copyright law protects original works of authorship.",
    "All license plates must be returned to the office before moving.",
]
# Notices of licences outside the families: unknown, however much they share with a template.
FOREIGN = [
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "Licensed under the GNU Affero General Public License, version 3.",
    "SPDX-License-Identifier: AGPL-3.0-only",
    "This program is made available under the terms of the Eclipse Public License, version 2.0.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "Use of this software is governed by the Business Source License 1.1.",
    "Licensed under the Server Side Public License, version 1.",
    "Released under the Artistic License, version 2.0.",
    "Licensed under the Example Corp License, Version 2.0.",
    "This software is licensed under a proprietary license of the vendor.",
    "Released under the Example Corp License.",
]
# Words that a notice of each family names itself by (lower case); without them no template confirms it.
NAMED_BY = {
    "Apache-2.0": r"\bapache\b|\bunless required by applicable law\b",
    "BSD-3-Clause": r"\bbsd\b|\bredistribution and use\b",
    "CC-BY-4.0": r"\bcc[ -]?by\b|creative commons",
    "CC-BY-NC-4.0": r"\bcc[ -]?by[ -]nc\b|non-?commercial",
    "CC-BY-SA-4.0": r"\bcc[ -]?by[ -]sa\b|share-?alike",
    "CC0-1.0": r"\bcc0\b|\bwaived all copyright\b",
    "GPL-2.0": r"\bgpl|\bgnu general\b|\bfree software foundation\b",
    "GPL-3.0": r"\bgpl|\bgnu general\b|\bfree software foundation\b",
    "ISC": r"\bisc\b|\bwith or without fee\b",
    "LGPL-3.0": r"\blgpl|\blesser general\b",
    "MIT": r"\bmit\b|\bfree of charge\b",
    "MPL-2.0": r"\bmpl\b|\bmozilla\b",
}
#: First parts of the families' names; those that are words of other languages too count only as they are written.
NAMES = sorted({k.split("-")[0] for k in TEMPLATES} - {"CC", "ISC", "MIT"})
CUE = rf"(?i:licen[cs]e|copyright|warrant|redistribut|permission|public domain|creative commons|spdx|mozilla|\bCC[ -]?BY|\b(?:{'|'.join(NAMES)}))|\b(?:ISC|MIT)\b"
#: Features, altered copies of each sentence, ordinary lines (bound), precision asked, overlap asked.
BUCKETS, COPIES, PLAIN_LINES, PRECISION, OVERLAP = 1 << 13, 60, 3_000, 0.99, 0.5
LABELS = [UNKNOWN, *TEMPLATES]
CLEAR = "size(tied) = 1"


def words(paragraph: Column) -> Column:
    """Lower-case words; dots and hyphens stay inside words such as version numbers."""
    plain = F.regexp_replace(F.lower(paragraph), r"[^\p{L}\p{N}.+-]+|[.-]+(?=\s|$)", " ")
    return F.filter(F.split(plain, r"\s+"), lambda w: w != "")


def pairs(tokens: Column) -> Column:
    return F.zip_with(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))), F.slice(tokens, F.lit(2), F.size(tokens)), lambda a, b: F.concat_ws(" ", a, b))


def vectors(rows: DataFrame) -> DataFrame:
    """Add ``tokens`` and ``features`` to rows with a paragraph."""
    rows = rows.withColumn("tokens", words(F.col("paragraph")))
    rows = rows.withColumn("terms", F.concat("tokens", pairs(F.col("tokens"))))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="terms", outputCol="features").transform(rows).drop("terms")


def training_rows(docs: DataFrame) -> DataFrame:
    """(paragraph, label, half): altered copies of notices and of other sentences, and ordinary lines."""
    spark = docs.sparkSession
    known = [(t, LABELS.index(k)) for k, own in TEMPLATES.items() for t in own] + [(t, 0) for t in OTHER + FOREIGN]
    base = spark.createDataFrame(known, "paragraph string, label int").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    # a copy loses about a tenth of its words; one half of the copies keeps all
    kept = F.filter(F.split("paragraph", " "), lambda w: (F.col("copy") % 2 == 0) | (F.pmod(F.xxhash64(w, "copy", "paragraph"), F.lit(10)) > 0))
    around = F.array(*map(F.lit, ["", "", "note", "the", "project", "code and data", "(c) 2020", "all files"]))
    side = F.element_at(around, F.pmod(F.xxhash64("copy", "paragraph"), F.lit(8)).cast("int") + 1)
    copies = base.select(F.concat_ws(" ", side, F.array_join(kept, " ")).alias("paragraph"), "label", F.pmod(F.xxhash64("paragraph", "copy"), F.lit(2)).alias("half"))
    lines = docs.select("doc_id", F.substring_index("text", "\n", 1).alias("paragraph")).where("paragraph <> ''").where(~F.col("paragraph").rlike(CUE))
    # ordinary lines: the first lines of the documents with the smallest id hashes
    n = docs.count()
    if n > 4 * PLAIN_LINES:
        lines = lines.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(4 * PLAIN_LINES / n * (1 << 30)))
    plain = lines.orderBy(F.xxhash64("doc_id"), "paragraph").limit(PLAIN_LINES).select("paragraph", F.lit(0).alias("label"), F.pmod(F.hash("paragraph"), F.lit(2)).cast("long").alias("half"))
    return copies.unionByName(plain)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


class Model:
    """A fitted regression and the probability asked of a family."""

    def __init__(self, fitted, threshold: float):
        self.fitted, self.threshold = fitted, threshold

    def predict(self, rows: DataFrame) -> DataFrame:
        """Add ``family`` (an index into LABELS), ``probability``, ``confirmed`` (the paragraph names the family, overlaps a template of
        it and no other licence's notice as much) and ``tied`` (the families that overlap as much, its own too)."""
        rows = self.fitted.transform(vectors(rows)).withColumn("p", vector_to_array("probability"))
        rows = rows.withColumn("family", F.col("prediction").cast("int")).withColumn("probability", F.array_max("p"))
        own = F.col("family") + 1
        named = F.element_at(F.array(F.lit(True), *(F.lower("paragraph").rlike(NAMED_BY[k]) for k in TEMPLATES)), own)

        def close(o):
            return (F.element_at(o, own) >= OVERLAP) & (F.element_at(o, own) > F.element_at(o, 1))

        def as_close(o):
            return F.filter(F.transform(o, lambda x, k: F.when(x >= F.element_at(o, own), k)), lambda k: k.isNotNull())

        # overlaps are computed once in each column: a filter on ``confirmed`` asks for them last
        rows = rows.withColumn("confirmed", (F.col("family") > 0) & (F.col("probability") >= self.threshold) & named & let(overlaps(F.col("tokens")), close))
        rows = rows.withColumn("tied", let(overlaps(F.col("tokens")), as_close))
        return rows.drop("p", "rawPrediction", "prediction", "features")

    def find(self, rows: DataFrame) -> DataFrame:
        """The paragraphs that a family is found in."""
        return self.predict(rows).where("confirmed")


def overlaps(tokens: Column) -> Column:
    """For each label, the largest share of word pairs that a paragraph and a template have in common, of the shorter one.

    The templates of "unknown" are the notices of other licences.
    """
    def literal(own):
        return F.array(*(F.array_distinct(pairs(words(F.lit(t)))) for t in own))

    templates = F.array(literal(FOREIGN), *(literal(own) for own in TEMPLATES.values()))
    own = F.array_distinct(pairs(tokens))
    def share(t):
        return F.size(F.array_intersect(own, t)) / F.greatest(F.least(F.size(own), F.size(t)), F.lit(1))

    return F.transform(templates, lambda family: F.coalesce(F.array_max(F.transform(family, share)), F.lit(0.0)))


def fit(docs: DataFrame) -> Model:
    """Train on one half of the rows, calibrate the threshold on the other."""
    rows = written(training_rows(docs), "notices")
    train = vectors(rows.where("half = 0").select("paragraph", "label"))
    fitted = LogisticRegression(family="multinomial", regParam=0.0005, maxIter=40, labelCol="label").fit(train)
    other = Model(fitted, 0.0).predict(rows.where("half = 1").select("paragraph", "label"))
    bins = other.where("family > 0").groupBy(F.floor(F.col("probability") * 100).alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("family") == F.col("label")).cast("int")).alias("good")).collect()  # at most 101 rows
    threshold, n, good = 1.0, 0, 0
    for r in sorted(bins, key=lambda r: -r["b"]):
        n, good = n + r["n"], good + r["good"]
        if good >= PRECISION * n:
            threshold = min(threshold, r["b"] / 100)
    return Model(fitted, max(threshold, 0.3))


def joined(found: DataFrame, rows: DataFrame) -> DataFrame:
    """(row, first, line, paragraph): lines between blank lines, joined without those that are clear by themselves."""
    clear = found.where(CLEAR).groupBy("row").agg(F.collect_set("line").alias("clear"))
    blocks = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.*").join(clear, "row", "left")
    rest = F.filter(F.transform("own", lambda p, i: F.struct((F.col("first") + i).alias("line"), p.alias("paragraph"))),
                    lambda x: F.coalesce(~F.array_contains("clear", x["line"]), F.lit(True)))
    blocks = blocks.withColumn("rest", rest).where(F.size("rest") > 1)
    cues = F.filter("rest", lambda x: x["paragraph"].rlike(CUE))
    return blocks.select("row", "first", F.get(cues, F.lit(0))["line"].alias("line"), F.array_join(F.transform("rest", lambda x: x["paragraph"]), " ").alias("paragraph")).where("line IS NOT NULL")


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: doc_id, n_paragraphs found, families, paragraphs (line:family)."""
    docs = id_text(docs)
    every = F.transform(F.split("text", "\n"), lambda p, i: F.struct(i.alias("line"), p.alias("paragraph")))
    may = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.when(F.col("text").rlike(CUE), every).otherwise(F.array().cast("array<struct<line:int,paragraph:string>>")).alias("every"))
    may = may.withColumn("blank", F.concat(F.array(F.lit(-1)), F.transform(F.filter("every", lambda x: F.trim(F.translate(x["paragraph"], "\t\r", "  ")) == ""), lambda x: x["line"]), F.array(F.size("every"))))
    cues = F.transform(F.filter("every", lambda x: x["paragraph"].rlike(CUE)), lambda x: x.withField("first", F.array_max(F.filter("blank", lambda b: b < x["line"])) + 1))
    spans = F.filter(F.zip_with(F.expr("slice(blank, 1, size(blank) - 1)"), F.expr("slice(blank, 2, size(blank))"), lambda a, b: F.struct((a + 1).alias("first"), (b - 1).alias("last"))), lambda x: x["last"] > x["first"])
    blocks = F.transform(spans, lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last"), F.transform(F.slice("every", x["first"] + 1, x["last"] - x["first"] + 1), lambda p: p["paragraph"]).alias("own")))
    blocks = F.filter(blocks, lambda b: F.exists(b["own"], lambda p: p.rlike(CUE)))
    rows = written(may.select("row", "doc_id", cues.alias("lines"), blocks.alias("blocks")), "lines")
    model = model or fit(docs)
    names = F.array(*map(F.lit, LABELS))
    lines = written(model.find(rows.select("row", F.explode("lines").alias("l")).select("row", "l.*")).select("row", "first", "line", "family", "tied"), "found-lines")
    wrapped = written(model.find(joined(lines, rows)).where(CLEAR).select("row", "first", "line", "family"), "found-blocks")
    clear = lines.where(CLEAR).drop("tied").unionByName(wrapped)
    owners = clear.groupBy("row", "first").agg(F.collect_set("family").alias("owners"))
    alone = lines.where(f"NOT {CLEAR}").join(owners, ["row", "first"], "left").where(~F.coalesce(F.arrays_overlap("tied", "owners"), F.lit(False)))
    found = clear.unionByName(alone.select(clear.columns))
    per_row = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("line", names[F.col("family")].alias("family")))).alias("found"))
    out = rows.select("row", "doc_id").join(per_row, "row", "left")
    none = F.array().cast("array<struct<line:int,family:string>>")
    own = F.coalesce("found", none)
    return out.select("doc_id", F.size(own).cast("long").alias("n_paragraphs"),
                      F.array_join(F.array_sort(F.array_distinct(F.transform(own, lambda x: x["family"]))), ",").alias("families"),
                      F.array_join(F.transform(own, lambda x: F.concat_ws(":", x["line"].cast("string"), x["family"])), ",").alias("paragraphs"))
