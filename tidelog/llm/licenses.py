"""License scans: a trained classifier of paragraphs, confirmed by templates.

Features are the word 1- and 2-grams of the templates that are rare elsewhere. A softmax regression over the license
families and an unknown class is fitted on the templates, parts of them and a bounded sample
of paragraphs of the corpus. It is fitted at the driver; paragraphs of the corpus are scored by
DataFrame functions alone. Neighbouring lines are scored together as well, for notices that are
wrapped; only what may be a notice is shuffled, to choose among overlapping ones.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Usual notices of the license families.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, dedicated to the public domain."),
]
UNKNOWN = "unknown"
SAMPLE_PARAGRAPHS = 4_000
CONFIRMED_AT = 0.7
_STEPS = 400
# A word or pair in more than this share of other paragraphs is no feature.
_MOST_ELSEWHERE = 0.01


def words_of(line: Column) -> Column:
    """Words in small ASCII letters and digits, an empty one where the line begins or ends with another character."""
    return F.split(F.lower(line), "[^a-z0-9]+")


def grams_of(words: Column) -> Column:
    """The different words and pairs of neighbouring words."""
    words = F.filter(words, lambda word: word != "")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, pairs))


@dataclass
class LicenseModel:
    families: list[str]  # the last is UNKNOWN
    features: list[str]
    weights: np.ndarray  # features x families
    bias: np.ndarray
    threshold: float  # least probability of a family that is not taken for unknown
    anchors: list[str]  # words of which a paragraph with any feature has at least one


def fit(docs: DataFrame, text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES) -> LicenseModel:
    """Fit on the templates and at most SAMPLE_PARAGRAPHS different paragraphs of ``docs`` as unknown.

    The sample is drawn by a hash, from paragraphs without most of a template's words and not mostly of its pairs; the threshold
    lies between the most probable of a held fifth of them and the least probable template.
    """
    spark = docs.sparkSession
    named = spark.createDataFrame(templates, "family string, line string")
    known = [(row["family"], row["words"]) for row in named.select("family", words_of(F.col("line")).alias("words")).collect()]
    grams = sorted({gram for _, words in known for gram in _grams(words)})
    families = sorted({family for family, _ in known}) + [UNKNOWN]
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line"))
    lines = lines.where("line <> ''").withColumn("draw", F.xxhash64("line"))
    drawn = lines.select("draw").distinct().orderBy("draw").limit(SAMPLE_PARAGRAPHS)
    chosen = lines.join(F.broadcast(drawn), "draw").dropDuplicates(["draw"])
    likeness = F.array_max(F.array(*[_containment(F.col("words"), words) for _, words in known]))
    # nor is a line unknown that is a part of a wrapped notice
    pairs = F.filter(grams_of(F.col("words")), lambda gram: F.contains(gram, F.lit(" ")))
    of_notices = F.size(F.array_intersect(pairs, _words([gram for gram in grams if " " in gram])))
    others = chosen.select("draw", words_of(F.col("line")).alias("words")).where((likeness < 0.5) & ((of_notices == 0) | (2 * of_notices < F.size(pairs))))
    sample = sorted(others.select("draw", _features(F.col("words"), grams).alias("found")).collect(), key=lambda row: row["draw"])
    elsewhere = Counter(gram for row in sample for gram in row["found"])
    rare = _MOST_ELSEWHERE * len(sample)
    # pairs of two frequent words say little, and would make every text worth a closer look
    features = [gram for gram in grams if elsewhere[gram] <= rare and min(elsewhere[word] for word in gram.split(" ")) <= rare]
    index = {gram: place for place, gram in enumerate(features)}
    rows, labels = [], []
    for family, words in known:  # whole notices and their beginnings and ends, as in wrapped lines
        for part in sorted({tuple(words), tuple(words[: max(4, len(words) * 2 // 3)]), tuple(words[-max(4, len(words) * 2 // 3):])}):
            rows.append([index[gram] for gram in _grams(part) if gram in index])
            labels.append(families.index(family))
    whole = len(rows)
    for found in [[], *[row["found"] for row in sample]]:  # a paragraph without a feature is unknown
        rows.append([index[gram] for gram in found if gram in index])
        labels.append(len(families) - 1)
    table = np.zeros((len(rows), len(features)))
    for place, found in enumerate(rows):
        table[place, found] = 1
    truth = np.eye(len(families))[labels]
    held = np.arange(len(rows)) >= whole + (len(rows) - whole) * 4 // 5
    # each class weighs the same, however many rows it has
    seen, wanted = table[~held], truth[~held]
    weight = (wanted / np.maximum(wanted.sum(axis=0), 1)).sum(axis=1, keepdims=True)
    weights, bias = np.zeros((len(features), len(families))), np.zeros(len(families))
    for _ in range(_STEPS):
        error = weight * (_softmax(seen @ weights + bias) - wanted)
        weights -= 2.0 * (seen.T @ error + 1e-4 * weights)
        bias -= 2.0 * error.sum(axis=0)
    likely = _softmax(table @ weights + bias)[:, :-1]
    of_templates = likely[np.arange(whole), labels[:whole]].min()
    of_others = likely[held].max() if held.any() else 0.0
    anchors = {min(gram.split(" "), key=lambda word: (elsewhere[word], word)) for gram in features}
    threshold = float(max(0.5, (of_templates + of_others) / 2))
    return LicenseModel(families, features, weights, bias, threshold, sorted(anchors))


def scan(
    docs: DataFrame, model: LicenseModel, id_col: str = "doc_id", text_col: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """One row for each license notice: id, paragraph, family, score, match, confirmed, line.

    A notice is a line, or neighbouring lines that are confirmed together: of overlapping ones the
    one with most pairs of words of a template, then the shortest. A line without words ends a
    notice. ``paragraph`` counts lines from 0 and is the first of the notice, ``score`` is the probability of the family, at least the model's
    threshold; ``match`` is the largest share of the words of one of the family's templates that the
    paragraph has, ``confirmed`` if that is CONFIRMED_AT or more. Texts that are null or blank give
    no rows, rows that repeat an id one each. Extra columns are not read.
    """
    known = docs.sparkSession.createDataFrame(templates, "family string, line string")
    named = [(row["family"], [word for word in row["words"] if word]) for row in known.select("family", words_of(F.col("line")).alias("words")).collect()]
    worded = _candidates(docs, model.anchors, [words for _, words in named], id_col, text_col)
    found = worded.withColumn("found", F.explode(F.array(_features(F.col("words"), model.features))))
    # constants: one row of weights for each of the few features of the templates, one after the other
    table, width = _numbers(model.weights.ravel()), len(model.families)
    row = lambda gram: F.slice(table, (F.array_position(_words(model.features), gram) - 1) * width + 1, width)
    totals = F.aggregate("found", _numbers(model.bias), lambda total, gram: F.zip_with(total, row(gram), lambda a, b: a + b))
    highest = F.array_max(F.col("totals"))
    likely = found.withColumn("totals", F.explode(F.array(totals))).withColumn("place", F.array_position("totals", highest).cast("int"))
    spread = F.aggregate("totals", F.lit(0.0), lambda total, one: total + F.exp(one - highest))
    scored = likely.withColumn("score", 1 / spread).where(
        (F.col("place") < len(model.families)) & (F.col("score") >= model.threshold)
    )
    family = F.element_at(_words(model.families), F.col("place"))
    own = {name: [words for other, words in named if other == name] for name, _ in named}
    match = F.coalesce(*[
        F.when(F.col("family") == name, F.greatest(*([_containment(F.col("words"), one) for one in many] * 2))) for name, many in own.items()
    ])
    pairs = F.coalesce(*[
        F.when(F.col("family") == name, F.greatest(*([_pairs_held(F.col("words"), one) for one in many] * 2))) for name, many in own.items()
    ])
    judged = scored.withColumn("family", family).withColumn("match", match).withColumn("confirmed", F.col("match") >= CONFIRMED_AT)
    judged = judged.where((F.col("lines") == 1) | F.col("confirmed"))
    # the best first; a line that is not confirmed stays where no confirmed notice has it
    ranked = judged.select("row", "id", F.struct(
        (~F.col("confirmed")).alias("doubtful"), (-pairs).alias("rank"), "lines", "paragraph", "family", "score", "match", "confirmed", "line",
    ).alias("notice"))
    gathered = ranked.groupBy("row").agg(F.first("id").alias("id"), F.array_sort(F.collect_list("notice")).alias("notices"))
    apart = lambda a, b: (a["paragraph"] + a["lines"] <= b["paragraph"]) | (b["paragraph"] + b["lines"] <= a["paragraph"])
    chosen = F.aggregate(
        "notices", F.slice("notices", 1, 0),
        lambda kept, one: F.when(F.forall(kept, lambda other: apart(one, other)), F.concat(kept, F.array(one))).otherwise(kept),
    )
    return gathered.select("id", F.explode(chosen).alias("notice")).select(F.col("id").alias(id_col), "notice.*").select(
        id_col, "paragraph", "family", "score", "match", "confirmed", "line"
    )


def _candidates(docs: DataFrame, anchors: list[str], templates: list[list[str]], id_col: str, text_col: str) -> DataFrame:
    """Lines with an anchor, and runs of neighbouring lines that a wrapped template may take up.

    Between the first and the last line of a run there are no more words than in the longest template.
    """
    longest = max(len(words) for words in templates)
    vocabulary = sorted({word for words in templates for word in words})
    split = docs.select(
        F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("texts")
    )
    # exploding an array of one keeps Spark from making the value anew for each use
    own = F.transform("texts", lambda line: F.filter(words_of(line), lambda word: word != ""))
    worded = split.withColumn("own", F.explode(F.array(own)))
    marked = worded.withColumn("able", F.explode(F.array(F.transform("own", lambda words: F.arrays_overlap(words, _words(anchors))))))
    # a paragraph without a feature is unknown; only the others need more than a look at their words
    some = marked.where(F.exists("able", lambda able: able))
    near = F.filter(F.sequence(F.lit(1), F.size("able")), lambda at: F.exists(F.slice("able", at, longest + 2), lambda able: able))
    started = some.withColumn("ahead", F.explode(F.transform(near, lambda at: F.struct(
        at.alias("at"), F.slice("own", at, longest + 2).alias("own"), F.slice("texts", at, longest + 2).alias("texts"),
    )))).select("id", "row", "ahead.*")
    blank = F.array_position(F.transform("own", lambda words: F.size(words) == 0), F.lit(True))
    upto = F.when(blank > 0, blank - 1).otherwise(F.size("own")).cast("int")
    inside = F.flatten(F.slice("own", 2, F.greatest(F.col("lines") - 2, F.lit(0))))
    ends = lambda place: F.arrays_overlap(F.element_at("own", place), _words(vocabulary))
    runs = started.withColumn("upto", upto).where("upto > 0").withColumn("lines", F.explode(F.sequence(F.lit(1), F.col("upto"))))
    runs = runs.where((F.col("lines") == 1) | (ends(F.lit(1)) & ends(F.col("lines")) & (F.size(inside) <= longest)))
    joined = runs.withColumn("words", F.explode(F.array(F.flatten(F.slice("own", F.lit(1), F.col("lines"))))))
    return joined.where(F.arrays_overlap("words", _words(anchors))).select(
        "id", "row", (F.col("at") - 1).alias("paragraph"), "lines", "words",
        F.array_join(F.slice("texts", F.lit(1), F.col("lines")), "\n").alias("line"),
    )


def _grams(words) -> set[str]:
    words = [word for word in words if word]
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


def _features(words: Column, features: list[str]) -> Column:
    return F.array_intersect(grams_of(words), _words(features))


def _containment(words: Column, template: list[str]) -> Column:
    own = sorted(set(template) - {""})
    return F.size(F.array_intersect(words, _words(own))) / len(own)


def _pairs_held(words: Column, template: list[str]) -> Column:
    own = sorted({gram for gram in _grams(template) if " " in gram})
    return F.size(F.array_intersect(grams_of(words), _words(own))) / len(own)


def _words(words: list[str]) -> Column:
    """A constant; from one string, since thousands of single literals take long to plan."""
    return F.split(F.lit("\n".join(words)), "\n")


def _numbers(numbers: np.ndarray) -> Column:
    return _words([repr(float(number)) for number in numbers]).cast("array<double>")


def _softmax(values: np.ndarray) -> np.ndarray:
    raised = np.exp(values - values.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)
