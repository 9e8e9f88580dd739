"""License scans (6): a trained paragraph classifier over sparse word n-grams, confirmed against templates.

Only DataFrame functions and Spark ML. A multinomial logistic regression over word pairs and triples, with an unknown
class beside the licence families, learns from pieces of public licence notices and, for the unknown class, from
sentences that merely speak of licences and a bounded sample of the corpus. Its probabilities are calibrated by a
temperature chosen on held-out pieces. It judges every paragraph of every text in one pass. That pass first
looks for certain word pairs: a bound over the weights proves that a paragraph without any of them is of the unknown
class. Paragraphs that the model gives to a family are compared with the notices. A predicted family counts when a template of it confirms it and the paragraph has more
n-grams of this family's notices than of any other's: versions and variants of a licence share nearly all their words.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmood.llm.base import query, stored, table

UNKNOWN = "unknown"
#: Corpus paragraphs in the training sample of the unknown class, about.
SAMPLE = 2_000
#: Least calibrated probability of a family, and least share of n-grams in common with a template of it.
PROBABILITY = 0.5
CONFIRMED = 0.6
#: The smallest pieces of a notice that the classifier learns from, in words.
PIECE_WORDS = 6
TEMPERATURES = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0]
VOCABULARY = 8_192

#: Public licence notices by family, neighbours of each other among them.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "Apache-1.1": [
        "The Apache Software License, Version 1.1.",
        "Licensed under the Apache Software License, Version 1.1.",
        "This product includes software developed by the Apache Software Foundation.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "Licensed under the GNU GPL v2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-unversioned": [
        "You should have received a copy of the GNU General Public License along with this program.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details.",
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "Licensed under the Simplified BSD License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License, Version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-ND-4.0": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-NC-SA-4.0": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC-ND-4.0": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "Public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "The author has dedicated the work to the public domain by waiving all rights under CC0 1.0 Universal.",
    ],
    "All-rights-reserved": [
        "Copyright by the authors. All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without prior written permission of the "
        "publisher.",
    ],
}
#: Sentences that speak of licences without granting one, for the unknown class.
OTHER = [
    "The driver was asked for a licence and the papers of the car.",
    "The company was licensed by the state to sell insurance in the county.",
    "She studied public law and wrote about copyright in the digital age.",
    "Version 2.0 of the program was released last week under heavy rain.",
    "The general public may not use this door without permission.",
    "All parts of the work are described in the following section of the file.",
    "You may find a copy of the report in the library of the university.",
    "Creative work in common rooms is free of charge for members.",
    "The terms of the agreement are subject to the approval of the board.",
    "The foundation published a report on free software and its users.",
    "No conditions of any kind were attached to the distribution of food.",
    "A person obtaining a ticket shall be included in the list of visitors.",
]


#: What lies between words: anything but letters, digits, dots, pluses and dashes, with the dots before it.
_BETWEEN = r"(?<!\.)\.*+(?:[^\p{L}\p{N}.+-]++|$)"


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _has_pair(text: str, pairs: list[int]) -> Column:
    """Whether two neighbouring words of a text have one of the hashes; the words are bound once, as a lambda's name."""
    found = F.transform(
        F.array(_words(text)),
        lambda w: F.exists(
            F.zip_with(w, F.slice(w, 2, F.size(w)), lambda a, b: F.xxhash64(a, b)), lambda pair: pair.isin(pairs)
        ),
    )
    return F.element_at(found, 1)


def _with_grams(frame: DataFrame, text: str) -> DataFrame:
    """Adds ``grams``, the pairs and triples of a text's words in lower case."""
    words = frame.withColumn("w", _words(text))
    pairs, triples = (NGram(n=n, inputCol="w", outputCol=f"grams_{n}") for n in (2, 3))
    both = triples.transform(pairs.transform(words))
    return both.withColumn("grams", F.concat("grams_2", "grams_3")).drop("w", "grams_2", "grams_3")


def _listed(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """Rows (family, text) from fixed lists, as literals of the plan."""
    pairs = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("text")) for f, t in rows])
    return spark.range(1).select(F.explode(pairs).alias("p")).select("p.family", "p.text")


def _pieces(notices: DataFrame) -> DataFrame:
    """Each notice whole, and all its runs of PIECE_WORDS and of twice as many words."""
    whole = notices.select("family", "text")
    words = notices.select("family", F.split("text", " ").alias("v"))
    cut = [
        words.filter(F.size("v") > n).select(
            "family", F.explode(F.expr(f"transform(sequence(1, size(v) - {n - 1}), i -> concat_ws(' ', slice(v, i, {n})))"))
            .alias("text"),
        )
        for n in (PIECE_WORDS, 2 * PIECE_WORDS)
    ]
    return whole.unionByName(cut[0]).unionByName(cut[1])


class LicenseModel:
    """The vectoriser, the regression, its temperature, the families with the unknown class last, the telling pairs."""

    def __init__(self, vectors, regression, families: list[str], temperature: float, pairs: list[str]):
        self.vectors, self.regression = vectors, regression
        self.families, self.temperature, self.pairs = families, temperature, pairs

    def likely(self, frame: DataFrame, text: str) -> DataFrame:
        """Rows of which a family, not the unknown class, is the most probable."""
        pair = F.split("pair", " ")
        listed = frame.sparkSession.range(1).select(F.explode(F.split(F.lit("\n".join(self.pairs)), "\n")).alias("pair"))
        hashed = listed.select(F.xxhash64(pair[0], pair[1]).alias("h"))
        # at most VOCABULARY
        telling = [r.h for r in hashed.collect()] if self.pairs else []
        known = F.col("prediction") < len(self.families) - 1
        rows = _with_grams(frame.filter(_has_pair(text, telling)), text)
        return self.regression.transform(self.vectors.transform(rows)).filter(known).select(*frame.columns)

    def probabilities(self, frame: DataFrame) -> DataFrame:
        """Adds ``p``, the calibrated probability of each family in order, to rows with ``grams``."""
        raw = self.regression.transform(self.vectors.transform(frame)).withColumn("z", vector_to_array("rawPrediction"))
        top = raw.withColumn("top", F.array_max("z"))
        t = self.temperature
        e = top.withColumn("e", F.expr(f"transform(z, x -> exp((x - top) / {t}D))"))
        share = F.expr("transform(e, x -> x / aggregate(e, 0D, (a, b) -> a + b))")
        dropped = ("features", "rawPrediction", "probability", "prediction", "z", "top", "e")
        return e.withColumn("p", share).drop(*dropped)


def _telling_pairs(vocabulary: list[str], regression, common: dict[str, int]) -> list[str]:
    """Word pairs of which every paragraph has one that the regression gives to a family.

    Every n-gram of the vocabulary counts with one pair: itself, or the rarer of a triple's two. Pairs are left out
    from the commonest on, as long as all n-grams that count with those left out, had a paragraph them all, would lift
    no family up to the unknown class.
    """
    weights, intercepts = regression.coefficientMatrix.toArray(), regression.interceptVector.toArray()
    lift = np.maximum(weights[:-1] - weights[-1], 0.0)
    gap = intercepts[-1] - intercepts[:-1]
    lifts: dict[str, np.ndarray] = {}
    for at, gram in enumerate(vocabulary):
        first, *rest = gram.split(" ")
        pairs = [f"{a} {b}" for a, b in zip([first, *rest], rest)]
        pair = min(pairs, key=lambda p: (common.get(p, 0), p))
        lifts[pair] = lifts.get(pair, 0.0) + lift[:, at]
    left_out, kept = np.zeros(len(gap)), []
    for pair in sorted(lifts, key=lambda p: (-common.get(p, 0), p)):
        if (left_out + lifts[pair] < gap - 1e-6).all():
            left_out = left_out + lifts[pair]
        else:
            kept.append(pair)
    if not (left_out < gap).all():
        raise ValueError("a paragraph without any n-gram would be given to a family")
    return kept


def _examples(paragraphs: DataFrame, sample: int) -> DataFrame:
    """Rows (family, text): the notices and their pieces, other sentences, and at most about ``sample`` corpus lines.

    The lines are distinct ones, chosen by the hash of their text among the number of all lines, so a line that
    fills the corpus counts once.
    """
    spark = paragraphs.sparkSession
    known = _pieces(_listed(spark, [(f, t) for f, texts in TEMPLATES.items() for t in texts]))
    other = _pieces(_listed(spark, [(UNKNOWN, t) for t in OTHER]))
    one_in = max(1, paragraphs.count() // sample)
    # the corpus speaks for the unknown class except where it quotes a notice
    quoted = F.lower("text").rlike("licen[sc]|copyright|rights reserved|public domain|redistribut|hereby granted")
    corpus = (
        paragraphs.filter((F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0) & ~quoted)
        .select(F.lit(UNKNOWN).alias("family"), "text").distinct()
    )
    return stored(known.unionByName(other).unionByName(corpus), "license-texts")


def train(paragraphs: DataFrame, sample: int = SAMPLE) -> LicenseModel:
    """From the notices and about ``sample`` of the corpus paragraphs (a column ``text``), whole ones."""
    families = sorted(TEMPLATES) + [UNKNOWN]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("double") - 1
    examples = _with_grams(_examples(paragraphs, sample), "text").withColumn("label", label)
    vectors = CountVectorizer(inputCol="grams", outputCol="features", binary=True, vocabSize=VOCABULARY).fit(
        examples.filter(F.col("family") != UNKNOWN)
    )
    # some thousand rows of at most VOCABULARY entries each: the fit goes over them many times
    coded = stored(
        vectors.transform(examples).select("label", "features", (F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("held")),
        "license-examples",
    )
    learner = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=25)
    trial = learner.fit(coded.filter("not held"))
    raw = trial.transform(coded.filter("held")).withColumn("z", vector_to_array("rawPrediction"))
    losses = [
        F.avg(F.expr(f"log(aggregate(transform(z, x -> exp((x - z[int(label)]) / {t}D)), 0D, (a, b) -> a + b))"))
        for t in TEMPERATURES
    ]
    found = raw.agg(*losses).first()
    temperature = min(zip(found, TEMPERATURES), key=lambda x: (x[0] is None, x[0]))[1]
    regression = learner.fit(coded)
    unknown = examples.filter(F.col("family") == UNKNOWN).select(F.explode(F.array_distinct("grams")).alias("gram"))
    # at most VOCABULARY
    counted = unknown.filter(F.col("gram").isin(vectors.vocabulary)).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    common = {r.gram: r.n for r in counted.collect()}
    return LicenseModel(vectors, regression, families, temperature, _telling_pairs(vectors.vocabulary, regression, common))


def paragraphs_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, paragraph, text): the lines of the texts, counted from 0."""
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), r"\r\n|\r|\n")
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(lines).alias("paragraph", "text"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns (doc_id, paragraph, family, probability, template, similarity): the licence paragraphs of all texts.

    A paragraph is a line, counted from 0, read whole however long. Null and empty texts have none. A notice that two
    families share word by word is given to neither. A row that repeats another's id and text
    adds nothing; null ids are kept. Of equally similar templates the first in order counts. No rows give no rows.
    """
    spark = docs.sparkSession
    lines = paragraphs_of(docs, id_col, text_col)
    model = train(lines)
    candidates = stored(
        model.likely(lines, "text").select("doc_id", "paragraph", "text").distinct(), "candidates"
    )
    # a table of its own: a filter on the result would otherwise repeat the whole model in its condition
    judged = stored(
        model.probabilities(_with_grams(candidates, "text")).withColumn("own", F.array_distinct("grams")), "judged-paragraphs"
    )
    best = F.expr(f"slice(p, 1, {len(model.families) - 1})")
    place = F.array_position(best, F.array_max(best)).cast("int")
    judged = judged.withColumn("probability", F.array_max(best)).withColumn("place", place).withColumn(
        "family", F.element_at(F.array(*[F.lit(f) for f in model.families]), F.col("place"))
    )
    likely = judged.filter(F.col("probability") >= PROBABILITY)

    templates = stored(
        _with_grams(_listed(spark, [(f, t) for f, texts in TEMPLATES.items() for t in texts]), "text").select(
            "family", F.col("text").alias("template"), F.array_distinct("grams").alias("theirs")
        ),
        "templates",
    )
    # the n-grams of each family's notices, a fixed list, as one literal in the order of the families
    notices = {r.family: r.grams for r in templates.groupBy("family").agg(F.flatten(F.collect_list("theirs")).alias("grams")).collect()}
    spoken = F.array(*[F.split(F.lit("\t".join(sorted(set(notices[f])))), "\t") for f in model.families[:-1]])
    counts = F.transform(spoken, lambda theirs: F.size(F.array_intersect("own", theirs)))
    # counted once: a name of a lambda, not a column that is written out wherever it is used
    ahead = F.transform(
        F.array(counts), lambda c: F.size(F.filter(c, lambda n: n >= F.element_at(c, F.col("place")))) == 1
    )
    likely = likely.filter(F.element_at(ahead, 1))

    shared = F.size(F.array_intersect("own", "theirs"))
    # a paragraph that is part of a notice, or a notice that is part of a paragraph
    similarity = shared / F.least(F.size("own"), F.size("theirs"))
    compared = likely.join(F.broadcast(templates), "family").select(
        "doc_id", "paragraph", "text", "family", "probability", "template", similarity.alias("similarity")
    )
    confirmed = compared.filter(F.col("similarity") >= CONFIRMED)
    first = F.max_by(F.struct("template", "similarity"), F.struct("similarity", (-F.length("template")).alias("l"), "template"))
    return confirmed.groupBy("doc_id", "paragraph", "text", "family", "probability").agg(first.alias("m")).select(
        "doc_id", "paragraph", "family", "probability", "m.template", "m.similarity"
    )


@query("op6_license_scan")
def op6_license_scan(spark, directory):
    return scan(table(spark, directory, "documents"))
